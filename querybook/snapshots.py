"""Snapshot selection: every order day is a snapshot of ``orders``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querybook.base import REF, Tables, query
from tidemark.sources import snapshots as s

COL = "o_orderdate"
ROWS = """SELECT o_orderkey, o_custkey, o_totalprice,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day
FROM orders WHERE """
DAY = "CAST(o_orderdate AS DATE)"
R = f"DATE '{REF}'"


def rows(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", "o_custkey", "o_totalprice", F.col(COL).cast("date").alias("day"))


def in_range(low: str, high: str) -> str:
    """Newest day in a range, as a subquery."""
    return f"(SELECT MAX({DAY}) FROM orders WHERE {DAY} BETWEEN {low} AND {high})"


def newest(n: int) -> str:
    return (
        f"(SELECT d FROM (SELECT DISTINCT {DAY} AS d FROM orders WHERE {DAY} <= {R}) AS t"
        f" ORDER BY d DESC LIMIT {n})"
    )


def trunc(unit: str, day: str) -> str:
    return f"CAST(date_trunc('{unit}', {day}) AS DATE)"


def back(unit: str, n: int) -> str:
    months = {"month": 1, "quarter": 3, "year": 12}
    span = f"{7 * n} DAY" if unit == "week" else f"{months[unit] * n} MONTH"
    return f"CAST({R} - INTERVAL {span} AS DATE)"


def period(unit: str, n: int) -> str:
    """Same period, not after the reference date."""
    return f"{trunc(unit, DAY)} = {trunc(unit, back(unit, n))} AND {DAY} <= {R}"


def last_in_period(unit: str, n: int) -> str:
    return f"(SELECT MAX({DAY}) FROM orders WHERE {period(unit, n)})"


def any_of(subqueries: list[str]) -> str:
    return " OR ".join(f"{DAY} IN {q}" for q in subqueries)


@query("scan_full", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def scan_full(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@query("snap_eq", ROWS + f"{DAY} = {R}")
def snap_eq(t: Tables) -> DataFrame:
    return rows(s.snapshot_eq(t.orders, REF, COL))


@query("snap_latest", ROWS + f"{DAY} = (SELECT MAX({DAY}) FROM orders)")
def snap_latest(t: Tables) -> DataFrame:
    return rows(s.snapshot_latest(t.orders, COL))


@query("snap_asof", ROWS + f"{DAY} = (SELECT MAX({DAY}) FROM orders WHERE {DAY} <= {R})")
def snap_asof(t: Tables) -> DataFrame:
    return rows(s.snapshot_asof(t.orders, REF, COL))


@query("hist_upto", ROWS + f"{DAY} <= {R}")
def hist_upto(t: Tables) -> DataFrame:
    return rows(s.history_upto(t.orders, REF, COL))


@query("hist_current_year", ROWS + f"year({DAY}) = year({R}) AND {DAY} <= {R}")
def hist_current_year(t: Tables) -> DataFrame:
    return rows(s.current_year_upto(t.orders, REF, COL))


@query("hist_last_90_days", ROWS + f"{DAY} BETWEEN {R} - 90 AND {R}")
def hist_last_90_days(t: Tables) -> DataFrame:
    return rows(s.last_n_days(t.orders, REF, 90, COL))


@query("hist_last_n_snapshots", ROWS + f"{DAY} IN {newest(6)}")
def hist_last_n_snapshots(t: Tables) -> DataFrame:
    return rows(s.last_n_snapshots(t.orders, REF, 5, COL))


def _register_period(unit: str, n: int) -> None:
    @query(f"snap_{unit}_close", ROWS + f"{DAY} = {last_in_period(unit, n)}")
    def close(t: Tables) -> DataFrame:
        return rows(s.period_snapshots(t.orders, REF, unit, n, col=COL))

    @query(f"snap_{unit}_full", ROWS + period(unit, n))
    def full(t: Tables) -> DataFrame:
        return rows(s.period_snapshots(t.orders, REF, unit, n, full=True, col=COL))


for _unit, _n in (("week", 2), ("month", 1), ("quarter", 1), ("year", 1)):
    _register_period(_unit, _n)


@query(
    "snap_week_by_number",
    ROWS
    + "year(CAST(o_orderdate AS DATE)) = 2000 AND week(CAST(o_orderdate AS DATE)) = 1"
    + f" AND {DAY} <= DATE '2001-01-05'",
)
def snap_week_by_number(t: Tables) -> DataFrame:
    """The week 52 weeks before 2001-01-05, identified by year and week number."""
    picked = s.period_snapshots(
        t.orders, "2001-01-05", "week", 52, full=True, col=COL, week_rule="calendar_year",
    )
    return rows(picked)


@query("snap_same_day_last_year", ROWS + f"{DAY} = {back('year', 1)}")
def snap_same_day_last_year(t: Tables) -> DataFrame:
    return rows(s.same_day_years_ago(t.orders, REF, 1, COL))


@query(
    "snap_month_end",
    ROWS + f"{DAY} = (SELECT MAX({DAY}) FROM orders"
    f" WHERE {trunc('month', DAY)} = {trunc('month', back('month', 2))})",
)
def snap_month_end(t: Tables) -> DataFrame:
    return rows(s.month_end_snapshot(t.orders, REF, 2, COL))


_OFFSETS = {"week": 2, "month": 2, "quarter": 1, "year": 2}
_CLOSES = [last_in_period(u, n) for u, upto in _OFFSETS.items() for n in range(upto + 1)]


@query(
    "hist_union",
    ROWS + any_of([newest(4), *_CLOSES, f"({back('year', 1)})"]),
)
def hist_union(t: Tables) -> DataFrame:
    picked = s.history_from(
        t.orders, REF, days=3, weeks=2, months=2, quarters=1, years=2, year_to_year=1, col=COL
    )
    return rows(picked)


@query("hist_union_full", ROWS + f"({period('week', 0)}) OR ({period('week', 1)}) OR ({period('month', 0)})")
def hist_union_full(t: Tables) -> DataFrame:
    return rows(s.history_from(t.orders, REF, weeks=1, months=0, full_period=True, col=COL))


def _year_back(n: int) -> str:
    start = f"CAST(date_trunc('year', {R}) - INTERVAL {n} YEAR AS DATE)"
    return in_range(start, f"CAST({start} + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE)")


def _month_back(n: int) -> str:
    start = trunc("month", back("month", n))
    return in_range(start, f"last_day({start})")


@query(
    "hist_comparison_calendar",
    ROWS + any_of(
        [newest(5), *[_month_back(n) for n in (1, 2, 3, 4)], _year_back(1), _year_back(2),
         f"({back('year', 1)})"]
    ),
)
def hist_comparison_calendar(t: Tables) -> DataFrame:
    return rows(s.comparison_calendar(t.orders, REF, 5, COL))


_LAST_WEEK = trunc("week", back("week", 1))
_QUARTER_END = f"last_day({back('month', 3)})"


@query(
    "hist_period_closes",
    ROWS + any_of(
        [f"({R})", in_range(_LAST_WEEK, f"{_LAST_WEEK} + 6"), _month_back(1),
         in_range(trunc("quarter", _QUARTER_END), _QUARTER_END), _year_back(1)]
    ),
)
def hist_period_closes(t: Tables) -> DataFrame:
    return rows(s.period_close_calendar(t.orders, REF, COL))


@query(
    "hist_limited",
    ROWS + any_of(
        [newest(6), in_range("DATE '0001-01-01'", f"last_day({back('month', 1)})"),
         in_range("DATE '0001-01-01'", f"CAST(date_trunc('year', {R}) AS DATE) - 1")]
    ),
)
def hist_limited(t: Tables) -> DataFrame:
    return rows(s.limited_history(t.orders, REF, 6, COL))


@query(
    "hist_incremental",
    ROWS + f"{DAY} <= {R} AND {DAY} > (SELECT MAX(CAST(l_shipdate AS DATE)) FROM lineitem"
    " WHERE l_shipdate < TIMESTAMP '2001-03-01 00:00:00')",
)
def hist_incremental(t: Tables) -> DataFrame:
    """Orders newer than what a target loaded up to the end of February has."""
    loaded = t.lineitem.where("l_shipdate < TIMESTAMP_NTZ'2001-03-01 00:00:00'").select(
        F.col("l_shipdate").alias(COL)
    )
    return rows(s.incremental_delta(t.orders, loaded, REF, COL))


@query(
    "hist_incremental_initial",
    ROWS + f"{DAY} <= {R}",
)
def hist_incremental_initial(t: Tables) -> DataFrame:
    """With an empty target everything up to the date is loaded."""
    return rows(s.incremental_delta(t.orders, t.orders.where("o_orderkey < 0"), REF, COL))


@query(
    "date_set_diff",
    """WITH o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
l AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)
SELECT CAST(COALESCE(o.d, l.d) AS VARCHAR) AS day,
       CASE WHEN l.d IS NULL THEN 'left' ELSE 'right' END AS side
FROM o FULL OUTER JOIN l ON o.d = l.d WHERE o.d IS NULL OR l.d IS NULL""",
)
def date_set_diff(t: Tables) -> DataFrame:
    left = t.orders.select(F.col("o_orderdate").alias("day"))
    return s.date_set_diff(left, t.lineitem.select(F.col("l_shipdate").alias("day")), "day")
