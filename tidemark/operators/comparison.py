"""A measure now against the same entity's value earlier.

The row-level operators expect **one row per key and day** (``daily_totals`` makes
it so, combining on the map side before the shuffle).  A key's window then holds
at most one row per calendar day, however hot the key is.  Histories that stay long,
as those ordered by time of day, are given with ``hot_rows``: keys with more rows are cut
into segments that are worked through in parallel (see :mod:`segments`), with equal results.

All columns made by one call share one exchange and one sort.  When only the
reference date's values are wanted, use :func:`values_as_of`: it is an
aggregation without any sort, and it reads only the days it needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import periods as p
from tidemark.functions.periods import DateLike
from tidemark.operators import segments as g
from tidemark.operators.joins import as_list, attach


class Period(NamedTuple):
    """``n`` units before the reference date, e.g. ``Period("month", 2)``."""

    unit: str
    n: int = 1


def past_name(by: str, unit: str, n: int = 1) -> str:
    """``last_month_x``, ``last_2_months_x``."""
    return f"{p.past_prefix(unit, n)}_{by}"


def daily_totals(
    df: DataFrame,
    keys: str | Sequence[str],
    date: str,
    sums: dict[str, Column],
    day: str = "day",
) -> DataFrame:
    """One row per key and day with summed measures."""
    on = [F.col(k) for k in as_list(keys)] + [p.day_of(date).alias(day)]
    return df.groupBy(*on).agg(*[F.sum(c).alias(name) for name, c in sums.items()])


def _ordered(keys: str | Sequence[str], order: str):
    return Window.partitionBy(*as_list(keys)).orderBy(order)


def _whole(keys: str | Sequence[str]):
    return Window.partitionBy(*as_list(keys))


# --- column forms: combine several in one select ------------------------------


def lag_column(by: str, n: int, keys: str | Sequence[str], order: str) -> Column:
    """Value ``n`` rows (snapshots) earlier."""
    return F.lag(by, n).over(_ordered(keys, order)).alias(past_name(by, "day", n))


def prev_period_column(
    by: str, date: DateLike, unit: str, n: int, keys: str | Sequence[str], order: str
) -> Column:
    """Last value of the period ``n`` units before the reference date.

    Rows after that period carry it, rows inside or before it have null: it is
    known only once the period has passed.
    """
    start, end = p.period_bounds(date, unit, n)
    day = p.day_of(order)
    inside = p.within(day, p.Bounds(start, end))
    value = F.max_by(F.when(inside, F.col(by)), F.when(inside, F.col(order)))
    after = day > p.date_lit(end)
    return F.when(after, value.over(_whole(keys))).alias(past_name(by, unit, n))


def same_day_last_year_column(
    by: str, date: DateLike, keys: str | Sequence[str], order: str
) -> Column:
    """Value on the same day of last year, carried from that day on."""
    day = p.date_lit(p.shift_back(date, "year", 1))
    value = F.max(F.when(p.day_of(order) == day, F.col(by))).over(_whole(keys))
    return F.when(p.day_of(order) >= day, value).alias(f"same_day_last_year_{by}")


def prev_observed_column(
    by: str,
    unit: str,
    keys: str | Sequence[str],
    order: str,
    exact: bool = False,
) -> Column:
    """Last value of the previous period *in which the key has rows*.

    The previous observed period may lie far back; with ``exact`` only the period
    directly before the row's own one counts.
    """
    rows = _ordered(keys, order)
    running = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    period = p.period_of(p.day_of(order), unit)
    before = F.lag(period).over(rows)
    closing = F.when(period != before, F.lag(by).over(rows))
    if not exact:
        return F.last(closing, ignorenulls=True).over(running)
    seen = F.when(period != before, F.struct(before.alias("period"), closing.alias("value")))
    latest = F.last(seen, ignorenulls=True).over(running)
    directly = latest["period"] == p.previous_period_of(p.day_of(order), unit)
    return F.when(directly, latest["value"])


# --- the same, asked of segments -------------------------------------------------


def _lag(by: str, n: int) -> g.Lag:
    return g.Lag(past_name(by, "day", n), by, n)


def _prev_period(by: str, date: DateLike, unit: str, n: int, order: str) -> g.Pick:
    span, day = p.period_bounds(date, unit, n), p.day_of(order)
    return g.Pick(past_name(by, unit, n), by, p.within(day, span), day > p.date_lit(span.end))


def _same_day(by: str, date: DateLike, order: str) -> g.Pick:
    then, day = p.date_lit(p.shift_back(date, "year", 1)), p.day_of(order)
    return g.Pick(f"same_day_last_year_{by}", by, day == then, day >= then)


# --- DataFrame forms -----------------------------------------------------------


def lag_value(
    df: DataFrame,
    by: str,
    n: int,
    keys: str | Sequence[str],
    order: str,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add the value ``n`` snapshots earlier."""
    if hot_rows is not None:
        return g.compare_in_segments(df, keys, order, lags=[_lag(by, n)], hot_rows=hot_rows)
    return df.select("*", lag_column(by, n, keys, order))


def prev_period_value(
    df: DataFrame,
    by: str | Sequence[str],
    date: DateLike,
    periods: Sequence[Period | tuple[str, int]],
    keys: str | Sequence[str],
    order: str,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add the last values of several periods before the reference date."""
    if hot_rows is not None:
        picks = [_prev_period(b, date, unit, n, order) for b in as_list(by) for unit, n in periods]
        return g.compare_in_segments(df, keys, order, picks=picks, hot_rows=hot_rows)
    return df.select(
        "*",
        *[
            prev_period_column(b, date, unit, n, keys, order)
            for b in as_list(by)
            for unit, n in periods
        ],
    )


def prev_observed_period_value(
    df: DataFrame,
    by: str,
    unit: str,
    keys: str | Sequence[str],
    order: str,
    exact: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add the last value of the previous observed period."""
    name = past_name(by, unit)
    if hot_rows is not None:
        return g.compare_in_segments(
            df, keys, order, observed=[g.Observed(name, by, unit, exact)], hot_rows=hot_rows
        )
    return df.select("*", prev_observed_column(by, unit, keys, order, exact).alias(name))


def same_day_last_year(
    df: DataFrame,
    by: str,
    date: DateLike,
    keys: str | Sequence[str],
    order: str,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add the value of the same day last year."""
    if hot_rows is not None:
        return g.compare_in_segments(df, keys, order, picks=[_same_day(by, date, order)], hot_rows=hot_rows)
    return df.select("*", same_day_last_year_column(by, date, keys, order))


def prev_observed_state(
    df: DataFrame,
    state: str,
    units: Sequence[str],
    keys: str | Sequence[str],
    order: str,
    decode: dict[str, Sequence[str]] | None = None,
    default: str | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add a categorical state at the end of the previous observed periods.

    ``decode`` maps a label to the codes it stands for; other codes become
    ``default`` and a missing state stays null.
    """
    names = [f"prev_{unit}_{state}" for unit in units]
    if hot_rows is not None:
        asked = [g.Observed(name, state, unit) for name, unit in zip(names, units, strict=True)]
        out = g.compare_in_segments(df, keys, order, observed=asked, hot_rows=hot_rows)
        if not decode:
            return out
        return out.select(*df.columns, *[decode_codes(F.col(n), decode, default).alias(n) for n in names])
    made = []
    for unit, name in zip(units, names, strict=True):
        column = prev_observed_column(state, unit, keys, order)
        if decode:
            column = decode_codes(column, decode, default)
        made.append(column.alias(name))
    return df.select("*", *made)


def decode_codes(
    column: Column, labels: dict[str, Sequence[str]], default: str | None = None
) -> Column:
    """Label of a code; null stays null."""
    decoded = F.when(column.isNull(), F.lit(None).cast("string"))
    for label, codes in labels.items():
        decoded = decoded.when(column.isin(*codes), F.lit(label))
    return decoded.otherwise(F.lit(default))


def propagate_balances(
    df: DataFrame,
    cols: str | Sequence[str],
    date: DateLike,
    keys: str | Sequence[str],
    order: str,
    days: Sequence[int] = (1, 2, 3, 4),
    periods: Sequence[Period | tuple[str, int]] = (
        ("month", 1), ("month", 2), ("month", 3), ("month", 4), ("year", 1), ("year", 2),
    ),
    observed: Sequence[str] = (),
    year_to_year: bool = True,
    hot_rows: int | None = None,
) -> DataFrame:
    """Every comparison column of several balances in one pass.

    One exchange and one sort serve all of them, whatever their number.
    """
    if hot_rows is not None:
        cols = as_list(cols)
        lags = [_lag(by, n) for by in cols for n in days]
        picks = [_prev_period(by, date, unit, n, order) for by in cols for unit, n in periods]
        picks += [_same_day(by, date, order) for by in cols if year_to_year]
        seen = [g.Observed(past_name(by, unit), by, unit) for by in cols for unit in observed]
        out = g.compare_in_segments(df, keys, order, lags, picks, seen, hot_rows)
        of = lambda by: [x.name for x in (*lags, *picks, *seen) if x.by == by]
        same_day = [f"same_day_last_year_{by}" for by in cols]
        names = [n for by in cols for n in (*[x for x in of(by) if x not in same_day], *[x for x in of(by) if x in same_day])]
        return out.select(*df.columns, *names)
    made: list[Column] = []
    for by in as_list(cols):
        made += [lag_column(by, n, keys, order) for n in days]
        made += [prev_period_column(by, date, unit, n, keys, order) for unit, n in periods]
        made += [
            prev_observed_column(by, unit, keys, order).alias(past_name(by, unit))
            for unit in observed
        ]
        if year_to_year:
            made.append(same_day_last_year_column(by, date, keys, order))
    return df.select("*", *made)


def values_as_of(
    df: DataFrame,
    cols: str | Sequence[str],
    date: DateLike,
    periods: Sequence[Period | tuple[str, int]],
    keys: str | Sequence[str],
    order: str,
    year_to_year: bool = False,
) -> DataFrame:
    """One row per key: its value on the reference date and at the end of each of
    the earlier periods.

    This is the aggregation form of :func:`prev_period_value` for the reference
    date.  It combines before the shuffle, needs no sort, and its range filter
    lets the scan skip every other partition.  Unlike the window form it also
    reports keys that have no row after a period.
    """
    date = p.as_date(date)
    spans = {(unit, n): p.period_bounds(date, unit, n) for unit, n in periods}
    wanted = [p.Bounds(date, date), *spans.values()]
    if year_to_year:
        same_day = p.shift_back(date, "year", 1)
        wanted.append(p.Bounds(same_day, same_day))
    day = p.day_of(order)
    keep = F.lit(False)
    for span in wanted:
        keep = keep | p.within(day, span)
    made = []
    for by in as_list(cols):
        made.append(F.max(F.when(day == p.date_lit(date), F.col(by))).alias(by))
        for (unit, n), span in spans.items():
            inside = p.within(day, span)
            value = F.max_by(F.when(inside, F.col(by)), F.when(inside, day))
            made.append(value.alias(past_name(by, unit, n)))
        if year_to_year:
            value = F.max(F.when(day == p.date_lit(same_day), F.col(by)))
            made.append(value.alias(f"same_day_last_year_{by}"))
    return df.where(keep).groupBy(*as_list(keys)).agg(*made)


def propagate_as_of(
    df: DataFrame,
    cols: str | Sequence[str],
    date: DateLike,
    keys: str | Sequence[str],
    order: str,
    days: Sequence[int] = (1, 2, 3, 4),
    periods: Sequence[Period | tuple[str, int]] = (
        ("month", 1), ("month", 2), ("month", 3), ("month", 4), ("year", 1), ("year", 2),
    ),
    observed: Sequence[str] = (),
    year_to_year: bool = True,
) -> DataFrame:
    """The rows of one date with all their comparison columns: what
    :func:`propagate_balances` gives for that date.

    The newest rows of a key are ranked, which Spark limits per key before the
    shuffle, and the period values are aggregated, so the history itself is neither
    shuffled nor sorted as a whole.  It is read for the ranks and for each observed unit,
    though: :func:`values_on_dates` reads the days it compares only, and
    :mod:`tidemark.operators.carried` keeps what later days need from day to day.
    """
    keys, cols = as_list(keys), as_list(cols)
    newest_first = Window.partitionBy(*keys).orderBy(F.desc(order))
    upto = df.where(p.day_of(order) <= p.date_lit(date))
    ranked = upto.select("*", F.row_number().over(newest_first).alias("__rank"))
    recent = ranked.where(F.col("__rank") <= max(days, default=0) + 1)

    def at(rank: int, column: str) -> Column:
        return F.max(F.when(F.col("__rank") == rank, F.col(column)))

    today = recent.groupBy(*keys).agg(
        *[at(1, c).alias(c) for c in df.columns if c not in keys],
        *[at(n + 1, c).alias(past_name(c, "day", n)) for c in cols for n in days],
    ).where(p.day_of(order) == p.date_lit(date))
    past = values_as_of(df, cols, date, periods, keys, order, year_to_year).drop(*cols)
    out = attach(today, past, keys)
    for unit in observed:
        out = attach(out, observed_as_of(df, cols, date, unit, keys, order), keys)
    return out


def observed_as_of(
    df: DataFrame,
    cols: str | Sequence[str],
    date: DateLike,
    unit: str,
    keys: str | Sequence[str],
    order: str,
) -> DataFrame:
    """One row per key: the last known close of a period before that of the date.

    The aggregation form of :func:`prev_observed_column`: the close of every period a
    key has rows in, then the latest of them, both combined before the shuffle.
    """
    keys, cols = as_list(keys), as_list(cols)
    day = p.day_of(order)
    before = df.where(day < p.date_lit(p.period_start(date, unit)))
    closes = before.groupBy(*keys, p.period_of(day, unit).alias("__period")).agg(
        *[F.max_by(c, day).alias(c) for c in cols]
    )
    known = lambda c: F.when(F.col(c).isNotNull(), F.col("__period"))
    return closes.groupBy(*keys).agg(*[F.max_by(c, known(c)).alias(past_name(c, unit)) for c in cols])


def values_on_dates(
    df: DataFrame,
    cols: str | Sequence[str],
    date: DateLike,
    calendar: dict[str, Date | None],
    keys: str | Sequence[str],
    order: str,
) -> DataFrame:
    """The rows of one date with each key's value on the dates of a calendar, which maps
    the beginning of a new column's name to its date.

    ``df`` may hold these days only (``snapshots.on_calendar``).  One aggregation gives all
    columns; a key without a row on a date has null there.
    """
    keys, cols = as_list(keys), as_list(cols)

    def on(day: DateLike | None, column: str) -> Column:
        here = F.lit(False) if day is None else p.day_of(order) == p.date_lit(day)
        return F.max(F.when(here, F.col(column)))

    return (
        df.groupBy(*keys)
        .agg(
            *[on(date, c).alias(c) for c in df.columns if c not in keys],
            *[on(d, c).alias(f"{name}_{c}") for c in cols for name, d in calendar.items()],
        )
        .where(p.day_of(order) == p.date_lit(date))
    )


# --- variations ----------------------------------------------------------------


def difference(now: Column, base: Column, null_rule: str = "unsigned") -> Column:
    """``now - base`` where either side may be missing.

    ``unsigned`` (the default) returns the side that is known as it is, so a value
    that has disappeared shows as a positive number; ``zero`` treats a missing
    side as 0.  Both missing gives 0.
    """
    if null_rule == "zero":
        return F.coalesce(now, F.lit(0)) - F.coalesce(base, F.lit(0))
    return F.coalesce(now - base, now, base, F.lit(0))


def ratio(part: Column, base: Column) -> Column:
    """``part / base``; null when the base is null or 0."""
    return F.try_divide(part, base)


# What each variation compares with.
VARIATIONS = (("week", "last_5_days"), ("month", "last_month"),
              ("quarter", "last_quarter"), ("year", "last_year"))


def _comparison_set(
    df: DataFrame, by: str, date: DateLike, keys: list[str], order: str, hot_rows: int | None
) -> DataFrame:
    if hot_rows is not None:
        picks = [_prev_period(by, date, unit, 1, order) for unit in ("month", "year")]
        seen = [g.Observed(past_name(by, "quarter"), by, "quarter")]
        return g.compare_in_segments(df, keys, order, [_lag(by, 5)], picks, seen, hot_rows)
    return df.select(
        "*",
        lag_column(by, 5, keys, order),
        prev_period_column(by, date, "month", 1, keys, order),
        prev_observed_column(by, "quarter", keys, order).alias(past_name(by, "quarter")),
        prev_period_column(by, date, "year", 1, keys, order),
    )


def _variation_columns(by: str, null_rule: str) -> list[Column]:
    made = []
    for label, base in VARIATIONS:
        past = F.col(f"{base}_{by}")
        change = difference(F.col(by), past, null_rule)
        made.append(change.alias(f"variation_{label}_{by}"))
        made.append(ratio(change, past).alias(f"variation_{label}_pct_{by}"))
    return made


def variation_kpis(
    df: DataFrame,
    by: str,
    date: DateLike,
    keys: str | Sequence[str],
    order: str,
    has_delta: bool = True,
    null_rule: str = "unsigned",
    hot_rows: int | None = None,
) -> DataFrame:
    """Absolute and relative variation against five snapshots ago, last month, the
    previous observed quarter and last year.

    With ``has_delta`` the same is done for ``delta_x``, the change since last
    year.  The second layer uses the same partitioning and order as the first, so
    it adds no exchange.
    """
    keys = as_list(keys)
    out = _comparison_set(df, by, date, keys, order, hot_rows)
    out = out.select("*", *_variation_columns(by, null_rule))
    if not has_delta:
        return out
    delta = f"delta_{by}"
    change = difference(F.col(by), F.col(f"last_year_{by}"), null_rule)
    out = _comparison_set(out.withColumn(delta, change), delta, date, keys, order, hot_rows)
    return out.select("*", *_variation_columns(delta, null_rule))
