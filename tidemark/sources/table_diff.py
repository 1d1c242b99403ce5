"""Where two tables of daily snapshots differ.

Equal sets of days say nothing about the rows.  Both tables are first reduced to checksums
of each day and range of keys that do not depend on the order of rows, and only what
differs is read again and compared row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import periods as p
from tidemark.operators.joins import as_list
from tidemark.sources.snapshots import SNAPSHOT, _on_dates


def _range(keys: Sequence[str], ranges: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(ranges)).cast("int")


def checksums(df: DataFrame, keys: str | Sequence[str], col: str = SNAPSHOT, ranges: int = 16) -> DataFrame:
    """One row per day and range of keys: the number of rows and two sums over their hashes,
    the same for the same rows in any order, repeated rows counted."""
    hashed = F.xxhash64(*sorted(df.columns))
    again = F.xxhash64(F.lit(1), *sorted(df.columns))
    return df.groupBy(p.day_of(col).alias("day"), _range(as_list(keys), ranges).alias("range")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(hashed.cast("decimal(20,0)")).alias("total"), F.bit_xor(again).alias("mixed")
    )


def differing(left: DataFrame, right: DataFrame, keys: str | Sequence[str], col: str = SNAPSHOT, ranges: int = 16) -> DataFrame:
    """(day, range) whose rows are not the same in both tables; a null day is a day."""
    sides = checksums(left, keys, col, ranges).unionByName(checksums(right, keys, col, ranges))
    seen = sides.groupBy("day", "range").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_distinct(c).alias(c) for c in ("rows", "total", "mixed")]
    )
    return seen.where("n < 2 OR rows > 1 OR total > 1 OR mixed > 1").select("day", "range")


def table_diff(
    left: DataFrame,
    right: DataFrame,
    keys: str | Sequence[str],
    col: str = SNAPSHOT,
    ranges: int = 16,
) -> DataFrame:
    """(keys, day, change) of every key and day whose rows differ: ``added`` if only the right
    table has the key on that day, ``removed`` if only the left one has, else ``changed``.

    Both tables have the same columns.  The days that differ come to the driver, as many as
    the calendar has at most, and become a filter on literals: equal days are not opened a
    second time, and of the others only ranges that differ are compared.  Null keys are
    keys; a key's repeated rows are compared with their number.
    """
    keys = as_list(keys)
    found = differing(left, right, keys, col, ranges).collect()
    days = {r["day"] for r in found if r["day"] is not None}
    parts: dict[int, list] = {}
    for r in found:
        parts.setdefault(r["range"], []).append(r["day"])
    wanted = F.lit(False)
    for number, of in parts.items():
        day = p.day_of(col).isin([F.lit(d) for d in of if d is not None])
        here = (day | p.day_of(col).isNull()) if None in of else day
        wanted = wanted | ((_range(keys, ranges) == number) & F.coalesce(here, F.lit(False)))

    def some(df: DataFrame, side: int) -> DataFrame:
        near = df if any(r["day"] is None for r in found) else _on_dates(df, days, col)
        return near.where(wanted).select(*left.columns, F.lit(side).alias("__side"))

    counted = some(left, 1).unionByName(some(right, -1)).groupBy(*left.columns).agg(F.sum("__side").alias("__more"))
    odd = counted.where("__more <> 0").groupBy(*keys, p.day_of(col).alias("day")).agg(
        F.max("__more").alias("__max"), F.min("__more").alias("__min")
    )
    had = _present(some(left, 1), keys, col, "__left")
    has = _present(some(right, -1), keys, col, "__right")
    both = had.unionByName(has, allowMissingColumns=True).groupBy(*keys, "day").agg(F.max("__left").alias("__left"), F.max("__right").alias("__right"))
    same = odd["day"].eqNullSafe(both["day"])
    for k in keys:
        same = same & odd[k].eqNullSafe(both[k])
    change = F.when(both["__left"].isNull(), "added").when(both["__right"].isNull(), "removed").otherwise("changed")
    return odd.join(both, same).select(*[odd[k] for k in keys], odd["day"], change.alias("change"))


def _present(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    return df.select(*keys, p.day_of(col).alias("day"), F.lit(True).alias(name)).distinct()
