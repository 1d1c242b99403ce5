"""Objectives: annual order value per nation and market segment as the objective,
the weekly shares of all orders as the season."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from querybook.base import Tables, cents, query
from tidemark.operators import comparison as c
from tidemark.operators import objectives as o

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

WEEK = "CAST((dayofyear(o_orderdate) - 1) // 7 + 1 AS INT)"
SEASON = f"""counts AS (
  SELECT CAST(year(o_orderdate) AS INT) AS year, {WEEK} AS week, COUNT(*) AS n FROM orders GROUP BY 1, 2),
shares AS (
  SELECT year, week, CAST(n * 10000 // SUM(n) OVER (PARTITION BY year) AS INT) AS points FROM counts),
season AS (
  SELECT year, week, CAST(points AS DECIMAL(9,0)) * 0.0001 AS pct_week,
    CAST(SUM(points) OVER (PARTITION BY year ORDER BY week) AS DECIMAL(9,0)) * 0.0001 AS pct_cum FROM shares)"""


def season(t: Tables) -> DataFrame:
    """Share of the year's orders per week, in whole basis points."""
    day = F.col("o_orderdate")
    counts = t.orders.groupBy(
        F.year(day).alias("year"), F.floor((F.dayofyear(day) - 1) / 7 + 1).cast("int").alias("week")
    ).agg(F.count("*").alias("n"))
    year = Window.partitionBy("year")
    points = F.floor(F.col("n") * 10000 / F.sum("n").over(year)).cast("decimal(9,0)")
    shares = counts.select("year", "week", points.alias("points"))
    upto = F.sum("points").over(year.orderBy("week")).cast("decimal(9,0)")
    point = F.lit(Decimal("0.0001"))
    return shares.select(
        "year", "week", (F.col("points") * point).alias("pct_week"), (upto * point).alias("pct_cum")
    )


OBJECTIVES = """objectives AS (
  SELECT c_nationkey, c_mktsegment AS product, CAST(year(o_orderdate) AS INT) AS year,
    CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS annual
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3)"""


def objectives(t: Tables) -> DataFrame:
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year")).agg(
        F.sum(cents("o_totalprice")).alias("total")
    )
    segments = t.customer.select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("product"))
    return per_customer.join(segments, "c_custkey").groupBy("c_nationkey", "product", "year").agg(
        F.sum("total").cast("decimal(18,2)").alias("annual")
    )


def wide(t: Tables) -> DataFrame:
    """One column per segment; null where a nation has no customers in it."""
    return objectives(t).groupBy("c_nationkey", "year").pivot("product", SEGMENTS).agg(F.first("annual"))


WIDE = OBJECTIVES + ", wide AS (SELECT c_nationkey, year, " + ", ".join(
    f"MAX(CASE WHEN product = '{s}' THEN annual END) AS {s}" for s in SEGMENTS
) + " FROM objectives GROUP BY 1, 2)"

BANDS = "CASE " + " ".join(
    f"WHEN week <= {last} THEN {i}" for i, last in enumerate((4, 8, 13, 17, 21, 26, 30, 35, 39, 43, 48, 53), 1)
) + " END"
QUARTERS = "CASE WHEN week <= 13 THEN 1 WHEN week <= 26 THEN 2 WHEN week <= 39 THEN 3 WHEN week <= 53 THEN 4 END"

_SPLIT = f"""WITH {SEASON}, {OBJECTIVES}, split AS (
  SELECT c_nationkey, product, year, annual, week, CAST({BANDS} AS INT) AS month, CAST({QUARTERS} AS INT) AS quarter,
    round(annual * CAST(pct_week AS DECIMAL(9,4)), 2) AS weekly, round(annual * CAST(pct_cum AS DECIMAL(9,4)), 2) AS cumulative
  FROM objectives JOIN season USING (year))
"""


@query(
    "objective_seasonal_split",
    _SPLIT + """SELECT c_nationkey, product, year, CAST(annual AS DOUBLE) AS annual, week, month, quarter,
  CAST(weekly AS DOUBLE) AS weekly, CAST(cumulative AS DOUBLE) AS cumulative,
  CAST(SUM(weekly) OVER (PARTITION BY c_nationkey, product, year, month) AS DOUBLE) AS monthly,
  CAST(SUM(weekly) OVER (PARTITION BY c_nationkey, product, year, quarter) AS DOUBLE) AS quarterly
FROM split""",
)
def objective_seasonal_split(t: Tables) -> DataFrame:
    return o.seasonal_split(objectives(t), season(t))


@query(
    "objective_unpivot",
    f"""WITH {OBJECTIVES}, pairs AS (SELECT DISTINCT c_nationkey, year FROM objectives),
products(product) AS (VALUES {", ".join(f"('{s}')" for s in SEGMENTS)})
SELECT pairs.c_nationkey, pairs.year, products.product, CAST(annual AS DOUBLE) AS annual
FROM pairs CROSS JOIN products LEFT JOIN objectives AS x
  ON x.c_nationkey = pairs.c_nationkey AND x.year = pairs.year AND x.product = products.product""",
)
def objective_unpivot(t: Tables) -> DataFrame:
    return o.unpivot_objectives(wide(t), ["c_nationkey", "year"])


@query(
    "objective_frequencies",
    _SPLIT + """SELECT c_nationkey, product, year, CAST(annual AS DOUBLE) AS annual, week, month, quarter,
  'S' AS frequency, CAST(weekly AS DOUBLE) AS objective FROM split
UNION ALL
SELECT c_nationkey, product, year, CAST(annual AS DOUBLE), week, month, quarter, 'C', CAST(cumulative AS DOUBLE) FROM split""",
)
def objective_frequencies(t: Tables) -> DataFrame:
    long = o.unpivot_objectives(wide(t), ["c_nationkey", "year"]).where("annual IS NOT NULL")
    return o.frequency_objectives(long, season(t))


_WITH_QUARTER = f"""WITH {SEASON}, quarters AS (SELECT *, CAST({QUARTERS} AS INT) AS quarter FROM season),
full_season AS (SELECT *, first_value(pct_cum) OVER (PARTITION BY year, quarter ORDER BY week DESC) AS pct_quarter FROM quarters)
"""


def season_with_quarters(t: Tables) -> DataFrame:
    marked = season(t).withColumn("quarter", o.band(F.col("week"), o.QUARTER_LAST_WEEK))
    return o.quarter_percent(marked)


@query(
    "objective_quarter_percent",
    _WITH_QUARTER + """SELECT year, week, quarter, CAST(pct_week AS DOUBLE) AS pct_week, CAST(pct_cum AS DOUBLE) AS pct_cum,
  CAST(pct_quarter AS DOUBLE) AS pct_quarter FROM full_season""",
)
def objective_quarter_percent(t: Tables) -> DataFrame:
    return season_with_quarters(t)


@query(
    "objective_of_week",
    f"""WITH {SEASON}, {WIDE} SELECT c_nationkey, wide.year, """ + ", ".join(
        f"CAST({s} AS DOUBLE) AS {s}, CAST({s} * CAST(pct_week AS DECIMAL(9,4)) AS DOUBLE) AS {s}_week,"
        f" CAST({s} * CAST(pct_cum AS DECIMAL(9,4)) AS DOUBLE) AS {s}_cum" for s in SEGMENTS
    ) + " FROM wide LEFT JOIN season ON season.year = wide.year AND season.week = 24",
)
def objective_of_week(t: Tables) -> DataFrame:
    """Every segment's objective of week 24 and up to it."""
    return o.week_objective(wide(t), season(t), F.lit(24), SEGMENTS, F.col("year"))


# Variations per nation and segment: order value per week against the quarter's and
# the year's first week; segment FURNITURE has no objective in even nations.
_KPI = f"""kpi AS (
  SELECT c_nationkey, c_mktsegment AS product, CAST(year(o_orderdate) AS INT) AS year, {WEEK} AS week,
    CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS variation_year,
    CAST(SUM(CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS variation_quarter
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3, 4)"""
_TARGETS = """targets AS (
  SELECT c_nationkey, product, CAST(MAX(annual) AS DOUBLE) AS annual FROM objectives
  GROUP BY 1, 2)"""


def kpi(t: Tables) -> DataFrame:
    price = cents("o_totalprice")
    segments = t.customer.select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("product"))
    day = F.col("o_orderdate")
    return t.orders.withColumnRenamed("o_custkey", "c_custkey").join(segments, "c_custkey").groupBy(
        "c_nationkey", "product", F.year(day).alias("year"),
        F.floor((F.dayofyear(day) - 1) / 7 + 1).cast("int").alias("week"),
    ).agg(
        F.sum(price).cast("double").alias("variation_year"),
        F.sum(F.when(F.col("o_orderstatus") != "P", price)).cast("double").alias("variation_quarter"),
    )


_A, _V, _Q = "targets.annual", "kpi.variation_year", "kpi.variation_quarter"
_OQ, _OP = f"CAST(s.pct_quarter AS DOUBLE) * {_A}", f"CAST(s.pct_cum AS DOUBLE) * {_A}"


@query(
    "objective_attainment",
    _WITH_QUARTER + f""", {OBJECTIVES}, {_KPI}, {_TARGETS}
SELECT kpi.c_nationkey, kpi.product, kpi.year, kpi.week, {_V}, {_Q}, {_A},
  CAST(s.pct_week AS DOUBLE) * {_A} AS objective_week, {_OQ} AS objective_quarter, {_OP} AS objective_period,
  CASE WHEN {_OP} <> 0 THEN {_V} / ({_OP}) END AS attainment_period,
  CASE WHEN {_OQ} <> 0 THEN {_Q} / ({_OQ}) END AS attainment_quarter,
  COALESCE({_OQ} - {_Q}, {_OQ}, {_Q}, 0) AS remaining_quarter,
  COALESCE({_A} - {_V}, {_A}, {_V}, 0) AS remaining_year
FROM kpi LEFT JOIN full_season AS s ON s.year = kpi.year AND s.week = kpi.week
LEFT JOIN targets ON targets.c_nationkey = kpi.c_nationkey AND targets.product = kpi.product""",
)
def objective_attainment(t: Tables) -> DataFrame:
    targets = (
        objectives(t)
        .groupBy("c_nationkey", "product")
        .agg(F.max("annual").cast("double").alias("annual"))
    )
    pct = ["pct_week", "pct_cum", "pct_quarter"]
    weeks = season_with_quarters(t).select("year", "week", *[F.col(p).cast("double").alias(p) for p in pct])
    return o.attainment(kpi(t), targets, weeks, "c_nationkey")


_GAP = """WITH balances AS (
  SELECT s_suppkey, s_nationkey, CAST(s_acctbal AS DECIMAL(18,2)) AS debit, CAST(-s_acctbal AS DECIMAL(18,2)) AS credit,
    CASE WHEN s_acctbal > 8000 THEN CAST(3 AS DECIMAL(9,2)) END AS target_a, CASE WHEN s_acctbal > 5000 THEN CAST(2 AS DECIMAL(9,2)) END AS target_b,
    CASE WHEN s_acctbal < 1000 THEN CAST(1.5 AS DECIMAL(9,2)) END AS target_c FROM supplier),
totals AS (
  SELECT s_nationkey, SUM(CASE WHEN target_a IS NOT NULL OR target_b IS NOT NULL OR target_c IS NOT NULL THEN debit END) AS d,
    SUM(CASE WHEN target_a IS NOT NULL OR target_b IS NOT NULL OR target_c IS NOT NULL THEN credit END) AS c FROM balances GROUP BY 1)
SELECT s_suppkey, s_nationkey, CAST(debit AS DOUBLE) AS debit, CAST(credit AS DOUBLE) AS credit,
  CAST(target_a * 1000000 AS DOUBLE) AS target_a, CAST(target_b * 1000000 AS DOUBLE) AS target_b, CAST(target_c * 1000000 AS DOUBLE) AS target_c,
  CAST(d AS DOUBLE) AS group_debit, CAST(c AS DOUBLE) AS group_credit,
  CAST(COALESCE(target_a, target_b) * 1000000 - d AS DOUBLE) AS gap_debit, CAST(target_c * 1000000 - c AS DOUBLE) AS gap_credit
FROM balances JOIN totals USING (s_nationkey)"""


@query("objective_gap", _GAP)
def objective_gap(t: Tables) -> DataFrame:
    balance = F.col("s_acctbal")

    def target(condition, value: str):
        return F.when(condition, F.lit(value).cast("decimal(9,2)"))

    rows = t.supplier.select(
        "s_suppkey", "s_nationkey", cents("s_acctbal").alias("debit"), (-cents("s_acctbal")).alias("credit"),
        target(balance > 8000, "3").alias("target_a"), target(balance > 5000, "2").alias("target_b"),
        target(balance < 1000, "1.5").alias("target_c"),
    )
    return o.objective_gap(rows, "s_nationkey", ["target_a", "target_b"], ["target_c"], "debit", "credit")


@query(
    "objective_variation",
    f"""WITH {_KPI}, {OBJECTIVES}
SELECT kpi.c_nationkey, kpi.product, kpi.year, kpi.week,
  COALESCE(CAST(annual AS DOUBLE) - variation_quarter, CAST(annual AS DOUBLE), variation_quarter, 0) AS remaining
FROM kpi LEFT JOIN objectives USING (c_nationkey, product, year)""",
)
def objective_variation(t: Tables) -> DataFrame:
    """What remains of the annual objective, with the missing-side rule."""
    annual = objectives(t).withColumn("annual", F.col("annual").cast("double"))
    joined = kpi(t).join(annual, ["c_nationkey", "product", "year"], "left")
    remaining = c.difference(F.col("annual"), F.col("variation_quarter"))
    return joined.select("c_nationkey", "product", "year", "week", remaining.alias("remaining"))
