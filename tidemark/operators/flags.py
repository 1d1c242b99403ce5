"""The ten period flags: week, month, quarter and year around a reference date.

Every operator here is one ``select`` of boolean range predicates on date
literals.  ``is_<name>_s``, ``_s_1``, ``_s_2`` are this week and the two before,
``_m...`` months, ``_t...`` quarters, ``_y...`` years.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import periods as p
from tidemark.functions.periods import DateLike
from tidemark.operators.joins import as_list


def _flags(name: str, predicate: Callable[[str, int], Column]) -> list[Column]:
    return [
        predicate(unit, n).alias(f"is_{name}_{suffix}")
        for suffix, unit, n in p.FLAG_PERIODS
    ]


def in_period_columns(
    day: Column, date: DateLike, name: str, week_rule: str = "iso"
) -> list[Column]:
    """The date falls inside the period."""

    def inside(unit: str, n: int) -> Column:
        if unit == "week" and week_rule == "calendar_year":
            return p.same_week_by_number(day, p.shift_back(date, "week", n))
        return p.within(day, p.period_bounds(date, unit, n))

    return _flags(name, inside)


def closed_by_columns(day: Column, date: DateLike, name: str) -> list[Column]:
    """The date is not after the close of the period."""
    return _flags(name, lambda unit, n: day <= p.date_lit(p.close_date(date, unit, n)))


def active_at_columns(
    start: Column, end: Column, date: DateLike, name: str
) -> list[Column]:
    """The interval ``[start, end)`` contains the close of the period."""

    def covers(unit: str, n: int) -> Column:
        close = p.date_lit(p.close_date(date, unit, n))
        return (start <= close) & (end > close)

    return _flags(name, covers)


def rolling_columns(
    day: Column, date: DateLike, name: str, months: int = 3
) -> list[Column]:
    """The date lies in the ``months`` months that end with the period's close."""
    return _flags(
        name,
        lambda unit, n: p.within(
            day, p.rolling_bounds(p.close_date(date, unit, n), months)
        ),
    )


def in_period_flags(
    df: DataFrame, by: str, date: DateLike, name: str, week_rule: str = "iso"
) -> DataFrame:
    return df.select("*", *in_period_columns(p.day_of(by), date, name, week_rule))


def closed_by_flags(df: DataFrame, by: str, date: DateLike, name: str) -> DataFrame:
    return df.select("*", *closed_by_columns(p.day_of(by), date, name))


def active_at_flags(
    df: DataFrame, start: str, end: str, date: DateLike, name: str
) -> DataFrame:
    return df.select("*", *active_at_columns(p.day_of(start), p.day_of(end), date, name))


def rolling_activity_flags(
    df: DataFrame, by: str, date: DateLike, name: str, months: int = 3
) -> DataFrame:
    return df.select("*", *rolling_columns(p.day_of(by), date, name, months))


def rollup_flags(
    df: DataFrame, keys: str | Sequence[str], names: str | Sequence[str]
) -> DataFrame:
    """OR of the ten flags over each key: true when any row of the key has it."""
    flags = [flag for name in as_list(names) for flag in p.flag_names(name)]
    return df.groupBy(*as_list(keys)).agg(*[F.max(flag).alias(flag) for flag in flags])


def rolled_up(
    df: DataFrame, keys: str | Sequence[str], columns: Sequence[Column], name: str
) -> DataFrame:
    """Flags computed and OR-ed in one aggregation."""
    flags = zip(p.flag_names(name), columns, strict=True)
    return df.groupBy(*as_list(keys)).agg(*[F.max(c).alias(flag) for flag, c in flags])


def first_event_flags(
    events: DataFrame, key: str | Sequence[str], ts: str, date: DateLike, name: str
) -> DataFrame:
    """Date of each key's first event, and whether it had happened by each close."""
    first = events.groupBy(*as_list(key)).agg(F.min(p.day_of(ts)).alias("first_event"))
    return closed_by_flags(first, "first_event", date, name)


def fill_flags(df: DataFrame, names: str | Sequence[str]) -> DataFrame:
    """Missing flags become false and all become 0/1."""
    flags = {f for name in as_list(names) for f in p.flag_names(name)}
    return df.select(
        *[
            F.coalesce(F.col(c), F.lit(False)).cast("int").alias(c) if c in flags else F.col(c)
            for c in df.columns
        ]
    )


# --- activity --------------------------------------------------------------------


def active_within(
    df: DataFrame,
    key: str | Sequence[str],
    ts: str,
    days: Sequence[int],
    snapshot: DateLike,
) -> DataFrame:
    """Each key's last event and whether it is within ``n`` days of the snapshot."""
    last = df.groupBy(*as_list(key)).agg(F.max(p.day_of(ts)).alias("last_event"))
    return last.select("*", *[recency_column("last_event", n, snapshot) for n in days])


def recency_column(last_event: str, n: int, snapshot: DateLike | Column) -> Column:
    """The event lies in the ``n`` days up to the snapshot; false when unknown.

    ``snapshot`` may be the row's own snapshot column.
    """
    at = snapshot if isinstance(snapshot, Column) else p.date_lit(snapshot)
    recent = p.day_of(last_event).between(F.date_sub(at, n), at)
    return F.coalesce(recent, F.lit(False)).alias(f"is_active_{n}d")


def event_counts(
    df: DataFrame, key: str | Sequence[str], ts: str, snapshot: str
) -> DataFrame:
    """Per key and snapshot date: the last event and the distinct event times in
    the snapshot's day, week and month.

    The rows are first reduced to distinct event times, which combines on the map
    side and spreads a hot key over its times; the counts then need no distinct.
    """
    at = p.day_of(snapshot)
    day = p.day_of(ts)
    on = [*as_list(key), snapshot]
    times = df.groupBy(*on, ts).agg(F.lit(1).alias("one"))
    counts = {
        "events_day": day == at,
        "events_week": p.period_of(day, "week") == p.period_of(at, "week"),
        "events_month": p.period_of(day, "month") == p.period_of(at, "month"),
    }
    return times.groupBy(*on).agg(
        F.max(ts).alias("last_event"),
        *[F.count(F.when(cond, F.lit(1))).alias(name) for name, cond in counts.items()],
    )


def sold_flags(
    df: DataFrame, by: str, snapshot: str, valid: Column, family: Column
) -> DataFrame:
    """``is_weekly``, ``is_monthly``, ``is_yearly``: valid, of the family and dated
    in the snapshot's own week, month or year, as 0/1."""
    day, at = p.day_of(by), p.day_of(snapshot)
    units = {"is_weekly": "week", "is_monthly": "month", "is_yearly": "year"}
    return df.select(
        "*",
        *[
            (valid & family & (p.period_of(day, unit) == p.period_of(at, unit)))
            .cast("int")
            .alias(name)
            for name, unit in units.items()
        ],
    )
