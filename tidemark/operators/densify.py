"""Filling gaps along a calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import periods as p
from tidemark.functions.periods import DateLike
from tidemark.operators.joins import as_list


def fill_nulls_bidirectional(
    df: DataFrame, cols: Sequence[str], keys: str | Sequence[str], order: str
) -> DataFrame:
    """Replace nulls with the key's next known value, else with its previous one.

    Meant for reference series such as rates: one row per key and day.
    """
    # Both are running frames, one from each end, so that time grows with the rows.
    running = (Window.unboundedPreceding, Window.currentRow)
    group = Window.partitionBy(*as_list(keys))
    behind = group.orderBy(F.col(order).asc_nulls_first()).rowsBetween(*running)
    ahead = group.orderBy(F.col(order).desc_nulls_last()).rowsBetween(*running)
    filled = {
        c: F.coalesce(
            F.last(c, ignorenulls=True).over(ahead),
            F.last(c, ignorenulls=True).over(behind),
        )
        for c in cols
    }
    return df.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def expected_dates(
    df: DataFrame,
    date: DateLike,
    col: str,
    expected: str = "expected_date",
    actual: str = "actual_date",
) -> DataFrame:
    """Each day of the year up to ``date`` with the snapshot that stands for it:
    its own, or the last one before it in the same year.

    The snapshots are first reduced, on the map side, to the set of their days (at
    most 366), so nothing is joined or sorted at the table's scale.
    """
    first, last = p.period_start(date, "year"), p.as_date(date)
    day = p.day_of(col)
    days = df.where(p.within(day, p.Bounds(first, last))).select(day.alias("day")).distinct()
    seen = days.groupBy().agg(F.array_sort(F.collect_list("day")).alias("seen"))
    spine = seen.select("seen", F.explode(F.sequence(F.lit(first), F.lit(last))).alias(expected))
    upto = F.filter("seen", lambda d: d <= F.col(expected))
    return spine.select(expected, F.try_element_at(upto, F.lit(-1)).alias(actual))
