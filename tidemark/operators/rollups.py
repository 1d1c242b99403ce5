"""Counts of long periods from daily partial results.

A day's events are reduced to one row per key whose measures can be merged: sums, counts,
extremes, and sets for distinct counts, exact or as a sketch.  Weeks, months, quarters and
years are merged from the days, so only a changed day's events are read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import periods as p
from tidemark.operators.joins import as_list

SUM, COUNT, MIN, MAX, DISTINCT, SKETCH = "sum", "count", "min", "max", "distinct", "sketch"
DAY = "day"


class Measure(NamedTuple):
    """How a column is kept by day: ``distinct`` keeps the day's set of values, ``sketch`` a
    HyperLogLog sketch whose count is an estimate."""

    kind: str
    column: str | None = None


def _kept(measure: Measure, name: str) -> Column:
    value = F.lit(1) if measure.column is None else F.col(measure.column)
    of = {
        SUM: F.sum, COUNT: F.count, MIN: F.min, MAX: F.max, SKETCH: F.hll_sketch_agg,
        DISTINCT: F.collect_set,
    }
    return of[measure.kind](value).alias(name)


def daily_partials(df: DataFrame, keys: str | Sequence[str], ts: str, measures: Mapping[str, Measure]) -> DataFrame:
    """One row per key and day with mergeable measures.  A set is bounded by a key's distinct
    values of one day; use a sketch where those are many."""
    made = [_kept(m, name) for name, m in measures.items()]
    return df.groupBy(*as_list(keys), p.day_of(ts).alias(DAY)).agg(*made)


def merged_periods(
    daily: DataFrame, keys: str | Sequence[str], unit: str, measures: Mapping[str, Measure]
) -> DataFrame:
    """(keys, period, measures) of weeks, months, quarters or years from the daily rows;
    ``period`` is its first day.

    Exact sets are merged as rows: (key, period, value) made distinct and counted, each
    measure by itself, so no set of a long period is held in one place.
    """
    keys = as_list(keys)
    on = [*keys, "period"]
    placed = daily.withColumn("period", p.period_of(F.col(DAY), unit).cast("date"))
    made = []
    for name, m in measures.items():
        if m.kind in (SUM, COUNT):
            made.append(F.sum(name).alias(name))
        elif m.kind in (MIN, MAX):
            made.append((F.min if m.kind == MIN else F.max)(name).alias(name))
        elif m.kind == SKETCH:
            made.append(F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name))
    out = placed.groupBy(*on).agg(*made) if made else placed.select(*on).distinct()
    for name, m in measures.items():
        if m.kind == DISTINCT:
            values = placed.select(*on, F.explode(name).alias("__value")).distinct()
            counts = values.groupBy(*on).agg(F.count(F.lit(1)).alias(name))
            same = F.lit(True)
            for k in on:
                same = same & out[k].eqNullSafe(counts[k])
            out = out.join(counts, same, "left").select(*[out[c] for c in out.columns], F.coalesce(counts[name], F.lit(0).cast("long")).alias(name))
    return out.select(*on, *measures)


def write_day(df: DataFrame, keys: str | Sequence[str], ts: str, measures: Mapping[str, Measure], folder: str, day: p.DateLike) -> None:
    """Replaces one day's partial results in ``folder`` by those of its events; only that
    day of ``df`` is read."""
    events = df.where(p.day_of(ts) == p.date_lit(day))
    daily_partials(events, keys, ts, measures).drop(DAY).write.mode("overwrite").parquet(f"{folder}/{DAY}={p.as_date(day)}")


def write_days(df: DataFrame, keys: str | Sequence[str], ts: str, measures: Mapping[str, Measure], folder: str) -> None:
    """The partial results of all days; rows without a time are left out."""
    days = daily_partials(df.where(F.col(ts).isNotNull()), keys, ts, measures)
    days.repartition(DAY).write.partitionBy(DAY).parquet(folder)
