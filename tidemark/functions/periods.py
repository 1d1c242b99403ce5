"""Calendar arithmetic.

Reference dates are plain arguments, so every bound is worked out once on the
driver and reaches Catalyst as a date literal.  A literal range can be pushed to
the scan and prunes partitions; ``year(col) = year(...)`` can not be used for
file statistics.
"""

from __future__ import annotations

import calendar
from datetime import date, datetime, timedelta
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = str | date | datetime

UNITS = ("week", "month", "quarter", "year")


class Bounds(NamedTuple):
    """First and last day of a period, both inclusive."""

    start: date
    end: date


def as_date(value: DateLike) -> date:
    """``'yyyy-MM-dd'`` text, a date or a datetime as a date."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return date.fromisoformat(value)


def date_lit(value: DateLike) -> Column:
    """A DATE literal."""
    return F.lit(as_date(value))


def add_months(day: DateLike, months: int) -> date:
    """Same day ``months`` later, or the last day of a shorter month."""
    day = as_date(day)
    years, month0 = divmod(day.year * 12 + day.month - 1 + months, 12)
    last = calendar.monthrange(years, month0 + 1)[1]
    return date(years, month0 + 1, min(day.day, last))


def shift_back(day: DateLike, unit: str, n: int) -> date:
    """The date ``n`` units before ``day``."""
    day = as_date(day)
    if unit == "day":
        return day - timedelta(days=n)
    if unit == "week":
        return day - timedelta(weeks=n)
    if unit == "month":
        return add_months(day, -n)
    if unit == "quarter":
        return add_months(day, -3 * n)
    if unit == "year":
        return add_months(day, -12 * n)
    raise ValueError(f"unknown unit {unit!r}")


def period_start(day: DateLike, unit: str) -> date:
    """First day of the week (Monday), month, quarter or year of ``day``."""
    day = as_date(day)
    if unit == "week":
        return day - timedelta(days=day.weekday())
    if unit == "month":
        return day.replace(day=1)
    if unit == "quarter":
        return date(day.year, 3 * ((day.month - 1) // 3) + 1, 1)
    if unit == "year":
        return date(day.year, 1, 1)
    raise ValueError(f"unknown unit {unit!r}")


def period_end(day: DateLike, unit: str) -> date:
    """Last day of the week (Sunday), month, quarter or year of ``day``."""
    start = period_start(day, unit)
    if unit == "week":
        return start + timedelta(days=6)
    months = {"month": 1, "quarter": 3, "year": 12}[unit]
    return add_months(start, months) - timedelta(days=1)


def period_bounds(day: DateLike, unit: str, n: int = 0) -> Bounds:
    """Bounds of the period that lies ``n`` units before the one of ``day``."""
    moved = shift_back(day, unit, n)
    return Bounds(period_start(moved, unit), period_end(moved, unit))


def close_date(day: DateLike, unit: str, n: int) -> date:
    """Day on which the period ``n`` units back is closed; the running one is
    closed by ``day`` itself."""
    return as_date(day) if n == 0 else period_bounds(day, unit, n).end


def months_between(later: DateLike, earlier: DateLike) -> float:
    """Months between two dates with 31-day fractions, as SQL counts them."""
    a, b = as_date(later), as_date(earlier)
    whole = (a.year - b.year) * 12 + a.month - b.month
    both_last = a == period_end(a, "month") and b == period_end(b, "month")
    return whole if a.day == b.day or both_last else whole + (a.day - b.day) / 31


def rolling_bounds(close: DateLike, months: int) -> Bounds:
    """Dates ``d`` with ``0 <= months_between(close, d) <= months`` as a range."""
    close = as_date(close)
    first = add_months(close, -months) - timedelta(days=4)
    while months_between(close, first) > months:
        first += timedelta(days=1)
    return Bounds(first, close)


# --- column forms -----------------------------------------------------------


def day_of(column: str | Column) -> Column:
    """The column as a DATE (a no-op on date columns)."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("date")


def within(column: Column, bounds: Bounds) -> Column:
    """``column`` lies inside the bounds; the column must be a DATE."""
    return column.between(date_lit(bounds.start), date_lit(bounds.end))


def period_of(column: Column, unit: str) -> Column:
    """First day of the column's period: the period's identity."""
    return F.trunc(column, unit)


def previous_period_of(column: Column, unit: str) -> Column:
    """First day of the period before the column's own one."""
    return F.trunc(F.date_sub(F.trunc(column, unit), 1), unit)


def first_day_of_week(column: Column) -> Column:
    """Monday of the column's week."""
    return F.trunc(column, "week")


def last_day_of_week(column: Column) -> Column:
    """Sunday of the column's week; a Sunday is its own last day."""
    return F.date_add(F.trunc(column, "week"), 6)


def same_week_by_number(column: Column, day: DateLike) -> Column:
    """Week identity as calendar year plus ISO week number.

    Around New Year this differs from :func:`period_of`: 2024-12-30 counts as
    week 1 of 2024.  It is kept for results that must match this rule.
    """
    day = as_date(day)
    return (F.year(column) == day.year) & (F.weekofyear(column) == day.isocalendar().week)


# Suffix, unit and offset of the ten period flags.
FLAG_PERIODS: tuple[tuple[str, str, int], ...] = (
    ("s", "week", 0),
    ("s_1", "week", 1),
    ("s_2", "week", 2),
    ("m", "month", 0),
    ("m_1", "month", 1),
    ("m_2", "month", 2),
    ("t", "quarter", 0),
    ("t_1", "quarter", 1),
    ("y", "year", 0),
    ("y_1", "year", 1),
)


def flag_names(name: str) -> list[str]:
    """Column names of the ten flags called ``name``."""
    return [f"is_{name}_{suffix}" for suffix, _, _ in FLAG_PERIODS]


def past_prefix(unit: str, n: int = 1) -> str:
    """``last_month``, ``last_2_months``: how columns of earlier values begin."""
    return f"last_{unit}" if n == 1 else f"last_{n}_{unit}s"
