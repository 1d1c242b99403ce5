"""Choosing snapshots of a table that keeps one full copy per day.

Operators that need "the newest snapshot such that ..." first find the few dates
with one small aggregation, then filter with date *literals*.  A filter on
literals prunes partitions when the scan is planned; joining the table with a
frame of dates reads every partition.

The dates come from the data by default.  For a catalog table
:func:`catalog_dates` reads them from the metadata without touching a file; pass
that list as ``dates`` and no scan is made at all.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date as Date
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import periods as p
from tidemark.functions.periods import Bounds, DateLike

SNAPSHOT = "partitiondate"
#: No snapshot is older; a search that goes back ends here.
EARLIEST = Date(1900, 1, 1)


# --- the dates a table holds -------------------------------------------------


def catalog_dates(spark: SparkSession, table: str, col: str = SNAPSHOT) -> DataFrame:
    """Snapshot dates of a partitioned catalog table, from its metadata."""
    parts = spark.sql(f"SHOW PARTITIONS {table}")
    if parts.columns == ["partition"]:
        value = F.regexp_extract("partition", rf"(?:^|/){col}=([^/]+)", 1)
    else:
        value = F.col(col)
    return parts.select(value.cast("date").alias(col)).distinct()


def snapshot_dates(df: DataFrame, col: str = SNAPSHOT) -> DataFrame:
    """Distinct snapshot dates: one column, one row per day."""
    return df.select(p.day_of(col).alias(col)).distinct()


def _dates(df: DataFrame, col: str, dates: DataFrame | None) -> DataFrame:
    return snapshot_dates(df, col) if dates is None else dates


def _on_dates(df: DataFrame, wanted: Iterable[Date], col: str) -> DataFrame:
    """Rows of the wanted days.  The enclosing range is added because it can be
    pushed to the scan of a timestamp column too, unlike the list."""
    wanted = sorted(wanted)
    if not wanted:
        return df.where(F.lit(False))
    span = p.within(p.day_of(col), Bounds(wanted[0], wanted[-1]))
    return df.where(span & p.day_of(col).isin([F.lit(d) for d in wanted]))


def _newest(dates: DataFrame, col: str) -> Date | None:
    return dates.agg(F.max(col)).first()[0]


def _period_filter(
    col: str, date: DateLike, unit: str, n: int, week_rule: str
) -> Column:
    """Dates of the period ``n`` units back that are not after ``date``."""
    not_after = p.day_of(col) <= p.date_lit(date)
    if unit == "week" and week_rule == "calendar_year":
        return not_after & p.same_week_by_number(
            p.day_of(col), p.shift_back(date, "week", n)
        )
    start, end = p.period_bounds(date, unit, n)
    return p.within(p.day_of(col), Bounds(start, min(end, p.as_date(date))))


# --- single snapshots and ranges --------------------------------------------


def snapshot_eq(df: DataFrame, date: DateLike, col: str = SNAPSHOT) -> DataFrame:
    """The snapshot of exactly one day."""
    return df.where(p.day_of(col) == p.date_lit(date))


def snapshot_latest(
    df: DataFrame, col: str = SNAPSHOT, dates: DataFrame | None = None
) -> DataFrame:
    """The newest snapshot."""
    newest = _newest(_dates(df, col, dates), col)
    return _on_dates(df, [] if newest is None else [newest], col)


def snapshot_asof(
    df: DataFrame, date: DateLike, col: str = SNAPSHOT, dates: DataFrame | None = None
) -> DataFrame:
    """The newest snapshot that is not after ``date``."""
    return _on_dates(df, _find(_dates(df, col, dates), date, col, recent=1), col)


def history_upto(df: DataFrame, date: DateLike, col: str = SNAPSHOT) -> DataFrame:
    """Every snapshot up to and including ``date``."""
    return df.where(p.day_of(col) <= p.date_lit(date))


def current_year_upto(df: DataFrame, date: DateLike, col: str = SNAPSHOT) -> DataFrame:
    """Snapshots of the calendar year of ``date``, up to ``date``."""
    year = Bounds(p.period_start(date, "year"), p.as_date(date))
    return df.where(p.within(p.day_of(col), year))


def last_n_days(
    df: DataFrame, date: DateLike, n: int = 90, col: str = SNAPSHOT
) -> DataFrame:
    """Snapshots in ``[date - n, date]``, both ends included."""
    span = Bounds(p.shift_back(date, "day", n), p.as_date(date))
    return df.where(p.within(p.day_of(col), span))


# --- date sets ---------------------------------------------------------------


def _between(col: str, first: Date, last: Date) -> Column:
    return p.within(F.col(col), Bounds(first, last))


def _gallop(dates: DataFrame, col: str, upto: Date, n: int, found: set[Date], low: Date) -> set[Date]:
    """``found``, which are all dates from ``low`` to ``upto``, and earlier ones until there
    are ``n``: the search goes back in ranges of growing length, each a filter on literals,
    so only partitions near the dates are opened.  It ends at ``EARLIEST``."""
    span = max((upto - low).days, 1)
    while len(found) < n and low > EARLIEST:
        span *= 4
        last, low = low - timedelta(days=1), max(low - timedelta(days=span), EARLIEST)
        more = dates.where(_between(col, low, last)).agg(F.collect_set(col)).first()[0]
        found = found.union(more)
    return found


def _first_span(upto: Date, n: int) -> Date:
    """Where a search for the ``n`` newest dates first looks back to."""
    return upto - timedelta(days=max(10, 2 * n))


def _find(
    dates: DataFrame,
    date: DateLike,
    col: str,
    last_in: list[Column] = (),
    all_in: list[Column] = (),
    recent: int = 0,
    last_upto: Iterable[Date] = (),
) -> set[Date]:
    """The newest date in each of ``last_in``, every date in any of ``all_in``, the
    ``recent`` newest dates not after ``date``, and the newest date not after each of
    ``last_upto``.

    One aggregation finds them, so a table that is not partitioned by day is scanned
    once, and only its date column.  The union of the ranges stands in front of it as a
    filter on literals, so that only partitions that can hold one of the dates are
    opened.  Where the newest dates lie farther back than their first range, the search
    goes on in further ranges.  What reaches the driver is one row a step.
    """
    day = F.col(col)
    searches = [(p.as_date(date), recent)] if recent else []
    searches += [(upto, 1) for upto in last_upto]
    spans = [_between(col, _first_span(upto, n), upto) for upto, n in searches]
    picks = [F.max(F.when(r, day)) for r in last_in]
    sets = [F.collect_set(F.when(r, day)) for r in (*all_in, *spans)]
    if not picks and not sets:
        return set()
    dates_in = dates.where(reduce(lambda a, b: a | b, [*last_in, *all_in, *spans]))
    found = dates_in.agg(*[c.alias(f"c{i}") for i, c in enumerate([*picks, *sets])]).first()
    out = {d for d in found[: len(picks)] if d is not None}
    out = out.union(*found[len(picks) : len(picks) + len(all_in)])
    for (upto, n), near in zip(searches, found[len(picks) + len(all_in) :], strict=True):
        newest = _gallop(dates, col, upto, n, set(near), _first_span(upto, n))
        out |= set(sorted(newest)[-n:])
    return out


def resolve_dates(
    dates: DataFrame,
    date: DateLike,
    days: int | None = None,
    weeks: int | None = None,
    months: int | None = None,
    quarters: int | None = None,
    years: int | None = None,
    year_to_year: int | None = None,
    full_period: bool = False,
    col: str = SNAPSHOT,
    week_rule: str = "iso",
) -> list[Date]:
    """The set of snapshot dates behind :func:`history_from`, oldest first.

    ``dates`` holds one row per day, so what is collected is bounded by the
    calendar and not by the size of the table.
    """
    offsets = {"week": weeks, "month": months, "quarter": quarters, "year": years}
    ranges = [
        _period_filter(col, date, unit, n, week_rule)
        for unit, upto in offsets.items()
        if upto is not None
        for n in range(upto + 1)
    ]
    if year_to_year:
        ranges.append(F.col(col) == p.date_lit(p.shift_back(date, "year", year_to_year)))
    kind = "all_in" if full_period else "last_in"
    recent = 0 if days is None else days + 1
    return sorted(_find(dates, date, col, recent=recent, **{kind: ranges}))


# --- snapshots by date set ---------------------------------------------------


def last_n_snapshots(
    df: DataFrame,
    date: DateLike,
    n: int = 1,
    col: str = SNAPSHOT,
    dates: DataFrame | None = None,
) -> DataFrame:
    """The newest ``n + 1`` snapshots not after ``date``.

    ``n`` counts snapshots *before* the newest one, so ``n=0`` keeps one.
    """
    found = resolve_dates(_dates(df, col, dates), date, days=n, col=col)
    return _on_dates(df, found, col)


def period_snapshots(
    df: DataFrame,
    date: DateLike,
    unit: str,
    n: int = 1,
    full: bool = False,
    col: str = SNAPSHOT,
    week_rule: str = "iso",
    dates: DataFrame | None = None,
) -> DataFrame:
    """Last snapshot of the period ``n`` units back, or all of them if ``full``."""
    inside = _period_filter(col, date, unit, n, week_rule)
    if full:
        return df.where(inside)
    return _on_dates(df, _find(_dates(df, col, dates), date, col, last_in=[inside]), col)


def same_day_years_ago(
    df: DataFrame, date: DateLike, n: int = 1, col: str = SNAPSHOT
) -> DataFrame:
    """The snapshot of the same day ``n`` years earlier, if there is one."""
    return snapshot_eq(df, p.shift_back(date, "year", n), col)


def month_end_snapshot(
    df: DataFrame,
    date: DateLike,
    n: int = 1,
    col: str = SNAPSHOT,
    dates: DataFrame | None = None,
) -> DataFrame:
    """The last snapshot inside the calendar month ``n`` months back."""
    month = p.within(F.col(col), p.period_bounds(date, "month", n))
    return _on_dates(df, _find(_dates(df, col, dates), date, col, last_in=[month]), col)


def history_from(
    df: DataFrame,
    date: DateLike,
    days: int | None = None,
    weeks: int | None = None,
    months: int | None = None,
    quarters: int | None = None,
    years: int | None = None,
    year_to_year: int | None = None,
    full_period: bool = False,
    col: str = SNAPSHOT,
    week_rule: str = "iso",
    dates: DataFrame | None = None,
) -> DataFrame:
    """Snapshots for a comparison: the newest days and the closes of the current
    and previous weeks, months, quarters and years.

    Each of ``days`` ... ``years`` switches its family on and reaches from offset
    0 to the given one; ``None`` leaves it out.  ``year_to_year`` adds the same
    day that many years earlier.  With ``full_period`` all snapshots of the
    periods are taken instead of the last ones.
    """
    found = resolve_dates(
        _dates(df, col, dates), date, days, weeks, months, quarters, years,
        year_to_year, full_period, col, week_rule,
    )
    return _on_dates(df, found, col)


def _preset(
    df: DataFrame,
    date: DateLike,
    col: str,
    dates: DataFrame | None,
    recent: int,
    ranges: list[Column],
    last_upto: Iterable[Date] = (),
) -> DataFrame:
    found = _find(_dates(df, col, dates), date, col, last_in=ranges, recent=recent, last_upto=last_upto)
    return _on_dates(df, found, col)


def comparison_calendar(
    df: DataFrame,
    date: DateLike,
    days: int = 5,
    col: str = SNAPSHOT,
    dates: DataFrame | None = None,
) -> DataFrame:
    """The balance-comparison preset: the ``days`` newest snapshots, the closes of
    the four previous months and two previous years, and the same day last year.
    A date that qualifies twice is read once."""
    same_day = p.shift_back(date, "year", 1)
    ranges = [p.period_bounds(date, "month", n) for n in (1, 2, 3, 4)]
    ranges += [p.period_bounds(date, "year", n) for n in (1, 2)]
    ranges.append(Bounds(same_day, same_day))
    return _preset(df, date, col, dates, days, [p.within(F.col(col), r) for r in ranges])


def comparison_dates(
    dates: DataFrame,
    date: DateLike,
    days: int = 4,
    periods: Iterable[tuple[str, int]] = (),
    year_to_year: bool = True,
    col: str = SNAPSHOT,
) -> dict[str, Date | None]:
    """The date behind every comparison of a run: ``last_day``, ``last_2_days`` ... for the
    snapshots before ``date``, ``last_month``, ``last_2_months`` ... for the last snapshot of
    earlier periods, ``same_day_last_year``; null where there is none.

    One aggregation over the snapshot dates (see :func:`catalog_dates`) finds them, and a
    search back in growing ranges the newest ones if they lie farther away.
    """
    day, before = F.col(col), p.shift_back(date, "day", 1)
    periods = list(periods)
    low = _first_span(before, days)
    spans = [p.within(day, p.period_bounds(date, unit, n)) for unit, n in periods]
    same_day = p.shift_back(date, "year", 1)
    picks = [*spans, day == p.date_lit(same_day)]
    near = _between(col, low, before)
    found = dates.where(reduce(lambda a, b: a | b, [near, *picks])).agg(
        F.collect_set(F.when(near, day)), *[F.max(F.when(pick, day)) for pick in picks]
    ).first()
    newest = _gallop(dates, col, before, days, set(found[0]), low)
    recent = [*sorted(newest, reverse=True)[:days], *[None] * days]
    out = {p.past_prefix("day", n + 1): recent[n] for n in range(days)}
    out.update({p.past_prefix(u, n): d for (u, n), d in zip(periods, found[1:], strict=False)})
    if year_to_year:
        out["same_day_last_year"] = found[-1]
    return out


def on_calendar(
    df: DataFrame, date: DateLike, calendar: dict[str, Date | None], col: str = SNAPSHOT
) -> DataFrame:
    """The snapshots of a date and of the dates it is compared with, as literals."""
    return _on_dates(df, {p.as_date(date), *calendar.values()} - {None}, col)


def period_close_calendar(
    df: DataFrame, date: DateLike, col: str = SNAPSHOT, dates: DataFrame | None = None
) -> DataFrame:
    """Today and the closes of the previous week, month, quarter and year.

    The previous quarter ends here with the month three months back, which is
    before the quarter's own end unless ``date`` is in a quarter's last month.
    """
    today = p.as_date(date)
    quarter_month = p.period_bounds(date, "month", 3)
    quarter = Bounds(p.period_start(quarter_month.end, "quarter"), quarter_month.end)
    ranges = [Bounds(today, today), p.period_bounds(date, "week", 1),
              p.period_bounds(date, "month", 1), quarter,
              p.period_bounds(date, "year", 1)]
    return _preset(df, date, col, dates, 0, [p.within(F.col(col), r) for r in ranges])


def limited_history(
    df: DataFrame,
    date: DateLike,
    n: int = 6,
    col: str = SNAPSHOT,
    dates: DataFrame | None = None,
) -> DataFrame:
    """The ``n`` newest snapshots, the newest one not after the previous month's
    end and the newest one not after the previous year's end."""
    closes = [p.period_bounds(date, unit, 1).end for unit in ("month", "year")]
    return _preset(df, date, col, dates, n, [], closes)


def incremental_delta(
    source: DataFrame, target: DataFrame | None, date: DateLike, col: str = SNAPSHOT
) -> DataFrame:
    """Source snapshots up to ``date`` that the target does not have yet.

    The target's newest snapshot not after ``date`` is the high-water mark; with
    no target, or an empty one, everything up to ``date`` is loaded.
    """
    upto = history_upto(source, date, col)
    if target is None:
        return upto
    mark = _find(snapshot_dates(target, col), date, col, recent=1)
    return upto.where(p.day_of(col) >= F.lit(max(mark) + timedelta(days=1))) if mark else upto


def date_set_diff(left: DataFrame, right: DataFrame, col: str = SNAPSHOT) -> DataFrame:
    """Snapshot dates that only one of two tables has, with the side that has it."""
    sides = snapshot_dates(left, col).withColumn("side", F.lit("left")).unionByName(
        snapshot_dates(right, col).withColumn("side", F.lit("right"))
    )
    return sides.groupBy(col).agg(F.min("side").alias("side"), F.max("side").alias("other")) \
        .where(F.col("side") == F.col("other")).drop("other")
