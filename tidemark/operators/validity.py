"""Slowly changing tables as intervals: a version is valid from its start up to, but not
with, its end; a null end is open."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import periods as p
from tidemark.operators.joins import as_list

_OPEN = Date(9999, 12, 31)


def _until(end: str) -> Column:
    return F.coalesce(p.day_of(end), F.lit(_OPEN))


def merged_versions(
    df: DataFrame, keys: str | Sequence[str], start: str, end: str, values: Sequence[str] = ()
) -> DataFrame:
    """Versions of equal ``values`` of a key that overlap or touch become one.

    A sweep over the starts: a version begins a new interval if all before it have ended.
    Versions of one start are first reduced to the longest, on the map side, so a key's
    sweep has at most one row per day.  Empty versions (``end`` not after ``start``) and
    those without a start are left out.  Nulls among keys and values are values.
    """
    on = [*as_list(keys), *values]
    first = p.day_of(start)
    longest = (
        df.where(first < _until(end))
        .groupBy(*on, first.alias("__start"))
        .agg(F.max(_until(end)).alias("__end"))
    )
    sweep = Window.partitionBy(*on).orderBy("__start")
    reached = F.max("__end").over(sweep.rowsBetween(Window.unboundedPreceding, -1))
    begins = longest.withColumn("__new", (reached.isNull() | (F.col("__start") > reached)).cast("int"))
    numbered = begins.withColumn("__island", F.sum("__new").over(sweep))
    merged = numbered.groupBy(*on, "__island").agg(F.min("__start").alias(start), F.max("__end").alias(end))
    return merged.select(*on, start, F.when(F.col(end) < F.lit(_OPEN), F.col(end)).alias(end))


def join_valid(
    df: DataFrame,
    versions: DataFrame,
    keys: str | Sequence[str],
    at: str,
    start: str,
    end: str,
    take: Sequence[str],
    how: str = "inner",
    bucket_days: int = 32,
) -> DataFrame:
    """``df`` with the columns ``take`` of every version that is valid at the row's own day.

    Both sides meet in buckets of ``bucket_days`` days of a key, so it is an equi-join with
    a filter and a hot key spreads over its buckets.  A version is in all buckets it
    touches between the rows' first and last day, which bounds open ones.  Null keys match
    null keys; ``left`` keeps rows without a valid version.
    """
    keys = as_list(keys)
    day = p.day_of(at)
    low, high = df.agg(F.min(day), F.max(day)).first()
    if low is None:
        low = high = Date(1970, 1, 1)
    bucket = lambda d: F.floor(F.unix_date(d) / bucket_days)
    begin = F.greatest(p.day_of(start), F.lit(low))
    last = F.least(F.date_sub(_until(end), 1), F.lit(high))
    spread = versions.where(begin <= last).select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        p.day_of(start).alias("__start"),
        _until(end).alias("__end"),
        *[F.col(c).alias(f"__take_{c}") for c in take],
        F.explode(F.sequence(bucket(begin), bucket(last))).alias("__bucket"),
    )
    rows = df.withColumns({"__at": day, "__own": bucket(day)})
    match = (F.col("__own") == F.col("__bucket")) & (F.col("__at") >= F.col("__start")) & (F.col("__at") < F.col("__end"))
    for k in keys:
        match = match & rows[k].eqNullSafe(spread[f"__{k}"])
    return rows.join(spread, match, how).select(*df.columns, *[F.col(f"__take_{c}").alias(c) for c in take])
