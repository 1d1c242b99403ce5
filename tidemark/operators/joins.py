"""Attaching per-group results to rows.

A total over a group could be a window, but a window brings all rows of the group
to one task, and one key may hold a third of a table.  Here the group result is a
``groupBy`` (combined on the map side) that is joined back: a plain equi-join,
which adaptive execution broadcasts when the measured size is small and splits
when a key is skewed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_list(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to as many tasks as the session's exchanges have.

    Adaptive execution joins partitions until a task reads some tens of MB, but rows that
    shrink well in an exchange need many times as much where they are sorted and grouped.
    Partitions of a number asked for are not joined, so a task's rows are their share.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def attach(
    df: DataFrame, per_group: DataFrame, keys: str | Sequence[str], how: str = "left"
) -> DataFrame:
    """Join ``per_group`` (one row per key) to ``df``; null keys match null keys."""
    keys = as_list(keys)
    renamed = per_group.withColumnsRenamed({k: f"__{k}" for k in keys})
    match = F.lit(True)
    for k in keys:
        match = match & df[k].eqNullSafe(renamed[f"__{k}"])
    return df.join(renamed, match, how).drop(*[f"__{k}" for k in keys])


def with_group_totals(
    df: DataFrame, keys: str | Sequence[str], totals: dict[str, Column]
) -> DataFrame:
    """Attach aggregates of each row's group to the row.

    ``totals`` maps the new column to an aggregate, for instance
    ``{"n_open": F.count_distinct(F.when(is_open, F.col("account")))}``.
    """
    keys = as_list(keys)
    grouped = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in totals.items()])
    return attach(df, grouped, keys)


def keep_group_extremes(
    df: DataFrame,
    keys: str | Sequence[str],
    cols: str | Sequence[str],
    largest: bool = True,
) -> DataFrame:
    """Rows that equal their group's maximum (or minimum) on every one of ``cols``.

    Ties are all kept.  Rows with a null in ``cols`` never qualify.
    """
    keys, cols = as_list(keys), as_list(cols)
    pick = F.max if largest else F.min
    best = df.groupBy(*keys).agg(*[pick(c).alias(f"__best_{c}") for c in cols])
    renamed = best.withColumnsRenamed({k: f"__{k}" for k in keys})
    match = F.lit(True)
    for k in keys:
        match = match & df[k].eqNullSafe(renamed[f"__{k}"])
    for c in cols:
        match = match & (df[c] == renamed[f"__best_{c}"])
    return df.join(renamed, match, "left_semi")


def spread_key(
    df: DataFrame, key: str | Column, free: Column, by: Sequence[str] | None = None
) -> Column:
    """A text join key that matches nothing where ``free`` holds, and ``key`` elsewhere.

    Rows that need no partner (often most of a table) then spread over all tasks by a
    hash of ``by`` (all columns by default) instead of meeting at one hot key, and they
    never match, whatever the other side holds.
    """
    key = F.col(key) if isinstance(key, str) else key
    hashed = F.xxhash64(*(by or df.columns)).cast("string")
    return F.when(free, F.concat(F.lit("\u0000#"), hashed)).otherwise(key)
