"""Annual objectives split over weeks, and attainment against them.

A season is a small table of one row per week of a year: ``year``, ``week`` (1-53),
``pct_week`` (share of the year) and ``pct_cum`` (share up to that week).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.comparison import difference, ratio
from tidemark.operators.joins import as_list, attach, with_group_totals

# Last week of each month and quarter band.
MONTH_LAST_WEEK = (4, 8, 13, 17, 21, 26, 30, 35, 39, 43, 48, 53)
QUARTER_LAST_WEEK = (13, 26, 39, 53)

SUM = "decimal(38,2)"


def band(week: Column, last_weeks: Sequence[int]) -> Column:
    """Number of the band of weeks that the week falls into, from 1."""
    number = F.when(week < 1, F.lit(None).cast("int"))
    for i, last in enumerate(last_weeks, start=1):
        number = number.when(week <= last, F.lit(i))
    return number


def season_arrays(season: DataFrame) -> DataFrame:
    """One row per year with its weeks as an array (at most 53 entries)."""
    week = F.struct(
        F.col("week").cast("int").alias("week"),
        F.col("pct_week").alias("pct_week"),
        F.col("pct_cum").alias("pct_cum"),
        band(F.col("week").cast("int"), MONTH_LAST_WEEK).alias("month"),
        band(F.col("week").cast("int"), QUARTER_LAST_WEEK).alias("quarter"),
    )
    return season.groupBy("year").agg(F.array_sort(F.collect_list(week)).alias("weeks"))


def seasonal_split(
    objectives: DataFrame, season: DataFrame, annual: str = "annual", year: str = "year"
) -> DataFrame:
    """Each objective in every week of its year: ``weekly`` and ``cumulative``
    objective, and the sums of the weekly ones over the ``month`` and ``quarter``.

    The year's weeks arrive as one array.  The month and quarter sums are taken
    from it inside the row, before it is expanded, so the expanded rows need no
    exchange.
    """
    weeks = season_arrays(season)
    objectives = objectives.withColumnRenamed(year, "year")
    yearly = F.col(annual)
    split = F.transform(
        "weeks",
        lambda w: w.withField("weekly", F.round(yearly * w["pct_week"], 2)).withField(
            "cumulative", F.round(yearly * w["pct_cum"], 2)
        ),
    )

    def band_sums(field: str, bands: int) -> Column:
        """Sum of the weekly objectives of each band, as an array."""
        zero = F.lit(0).cast(SUM)

        def of_band(number: Column) -> Column:
            inside = F.filter("split", lambda w: w[field] == number)
            return F.aggregate(
                inside, zero, lambda acc, w: (acc + F.coalesce(w["weekly"], zero)).cast(SUM)
            )

        return F.transform(F.sequence(F.lit(1), F.lit(bands)), of_band)

    # one row per calendar year: safe to broadcast
    joined = objectives.join(F.broadcast(weeks), "year").select(
        *objectives.columns, split.alias("split")
    )
    summed = joined.select(
        "*",
        band_sums("month", len(MONTH_LAST_WEEK)).alias("by_month"),
        band_sums("quarter", len(QUARTER_LAST_WEEK)).alias("by_quarter"),
    )
    full = F.transform(
        "split",
        lambda w: w.withField("monthly", F.get("by_month", w["month"] - 1)).withField(
            "quarterly", F.get("by_quarter", w["quarter"] - 1)
        ),
    )
    rows = summed.select(*objectives.columns, F.explode(full).alias("w"))
    made = ["week", "month", "quarter", "weekly", "cumulative", "monthly", "quarterly"]
    return rows.select(*objectives.columns, *[f"w.{name}" for name in made])


def unpivot_objectives(
    df: DataFrame, ids: Sequence[str], products: Sequence[str] | None = None
) -> DataFrame:
    """One column per product as rows ``(ids, product, annual)``."""
    values = list(products) if products else [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), values, "product", "annual")


def frequency_objectives(
    objectives: DataFrame, season: DataFrame, annual: str = "annual", year: str = "year"
) -> DataFrame:
    """Objectives by week in long form: frequency ``S`` (the week) and ``C``
    (cumulative)."""
    split = seasonal_split(objectives, season, annual, year)
    kept = [c for c in split.columns if c not in ("weekly", "cumulative", "monthly", "quarterly")]
    both = F.array(
        F.struct(F.lit("S").alias("frequency"), F.col("weekly").alias("objective")),
        F.struct(F.lit("C").alias("frequency"), F.col("cumulative").alias("objective")),
    )
    return split.select(*kept, F.inline(both))


def quarter_percent(
    season: DataFrame, quarter: str = "quarter", keys: Sequence[str] = ("year",)
) -> DataFrame:
    """Add the cumulative percentage at the last week of each quarter."""
    last = season.groupBy(*keys, quarter).agg(F.max_by("pct_cum", "week").alias("pct_quarter"))
    return attach(season, last, [*keys, quarter])


def week_objective(
    objectives: DataFrame, season: DataFrame, week: Column, products: Sequence[str],
    year: Column,
) -> DataFrame:
    """Wide objectives with each product's objective of one week and up to it."""
    keyed = objectives.withColumns({"__week": week, "__year": year})
    pct = season.select(
        F.col("year").alias("__year"), F.col("week").alias("__week"), "pct_week", "pct_cum"
    )
    joined = keyed.join(pct, ["__year", "__week"], "left")
    return joined.select(
        *objectives.columns,
        *[(F.col(o) * F.col("pct_week")).alias(f"{o}_week") for o in products],
        *[(F.col(o) * F.col("pct_cum")).alias(f"{o}_cum") for o in products],
    )


def attainment(
    kpi: DataFrame,
    objectives: DataFrame,
    season: DataFrame,
    unit: str | Sequence[str],
    product: str = "product",
    variation_year: str = "variation_year",
    variation_quarter: str = "variation_quarter",
) -> DataFrame:
    """How far each unit and product is with its objective.

    ``kpi`` has the unit, product, ``year``, ``week`` and the two variations;
    ``objectives(unit, product, annual)``; ``season`` also has ``pct_quarter``.
    Adds the objectives of the week, quarter and period to date, attainment
    (variation / objective, null when the objective is 0 or unknown) and what
    remains (the side that is known when the other one is not).
    """
    on = as_list(unit)
    # all rows of a report share a week or a few: not a key to shuffle on
    seasonal = kpi.join(season, ["year", "week"], "left")
    joined = seasonal.join(objectives, [*on, product], "left")
    annual = F.col("annual")
    period, quarter = F.col("pct_cum") * annual, F.col("pct_quarter") * annual
    v_year, v_quarter = F.col(variation_year), F.col(variation_quarter)
    return joined.select(
        *kpi.columns,
        "annual",
        (F.col("pct_week") * annual).alias("objective_week"),
        quarter.alias("objective_quarter"),
        period.alias("objective_period"),
        ratio(v_year, period).alias("attainment_period"),
        ratio(v_quarter, quarter).alias("attainment_quarter"),
        difference(quarter, v_quarter).alias("remaining_quarter"),
        difference(annual, v_year).alias("remaining_year"),
    )


def objective_gap(
    df: DataFrame,
    keys: str | Sequence[str],
    debit_objectives: Sequence[str],
    credit_objectives: Sequence[str],
    debit: str,
    credit: str,
    scale: int = 1_000_000,
) -> DataFrame:
    """Gap between the objectives (given in millions) and the group's past balance.

    Totals of ``debit`` and ``credit`` count only rows that have any objective.
    ``gap_debit`` takes the first objective of ``debit_objectives`` that is set,
    ``gap_credit`` likewise.
    """
    objectives = [*debit_objectives, *credit_objectives]
    has_any = F.coalesce(*[F.col(o) for o in objectives]).isNotNull()
    totals = {
        "group_debit": F.sum(F.when(has_any, F.col(debit))),
        "group_credit": F.sum(F.when(has_any, F.col(credit))),
    }
    out = with_group_totals(df, keys, totals)
    scaled = {o: F.col(o) * F.lit(scale) for o in objectives}
    first_debit = F.coalesce(*[scaled[o] for o in debit_objectives])
    first_credit = F.coalesce(*[scaled[o] for o in credit_objectives])
    return out.select(
        *[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns],
        "group_debit", "group_credit",
        (first_debit - F.col("group_debit")).alias("gap_debit"),
        (first_credit - F.col("group_credit")).alias("gap_credit"),
    )
