"""One row, or the newest rows, per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import periods as p
from tidemark.functions.periods import DateLike
from tidemark.operators.joins import as_list, keep_group_extremes


def latest_by(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    ascending: bool = False,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """The newest row of each key, or the oldest with ``ascending``.

    ``ties`` completes the order, so that the result does not depend on how rows
    are distributed; by default all other columns do, as far as they can be ordered.  ``row_number() = 1`` is a form Spark limits per key *before*
    the shuffle: each map task sends one row per key, also for a hot key.
    """
    if ties is None:
        used = {*as_list(keys), *as_list(order)}
        rest = [f for f in df.schema.fields if f.name not in used]
        ties = [f.name for f in rest if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    direction = F.asc_nulls_last if ascending else F.desc_nulls_last
    by = [direction(c) for c in as_list(order)] + [F.asc_nulls_last(c) for c in ties]
    rank = F.row_number().over(Window.partitionBy(*as_list(keys)).orderBy(*by))
    return df.select("*", rank.alias("__rank")).where("__rank = 1").drop("__rank")


def latest_attribute(
    df: DataFrame, keys: str | Sequence[str], attr: str, order: str
) -> DataFrame:
    """Each key with the attribute of its newest row; on equal dates the larger
    attribute wins."""
    newest = F.max_by(attr, F.struct(order, attr))
    return df.groupBy(*as_list(keys)).agg(newest.alias(attr))


def week_of_month(day: Column) -> Column:
    """Week of the month, weeks starting where the month's first day falls."""
    return F.ceil((F.dayofmonth(day) + F.dayofweek(day) - 1) / 7)


def last_per_week_of_month(
    df: DataFrame, date: str, keys: str | Sequence[str]
) -> DataFrame:
    """Newest rows of each key in each week of each month (ties are kept)."""
    day = p.day_of(date)
    marked = df.withColumns(
        {"__month": F.trunc(day, "month"), "__week": week_of_month(day)}
    )
    newest = keep_group_extremes(marked, [*as_list(keys), "__month", "__week"], date)
    return newest.drop("__month", "__week")


def valid_at(
    df: DataFrame,
    date: DateLike | Column,
    end: str = "dfval",
    inclusive: bool = False,
) -> DataFrame:
    """Rows of a slowly changing table whose validity ends after ``date``.

    ``date`` may be a column, such as the row's own snapshot date.
    """
    at = date if isinstance(date, Column) else p.date_lit(date)
    until = p.day_of(end)
    return df.where(until >= at if inclusive else until > at)
