"""Sharding by jump consistent hashing.

The shard is a pure function of the key and the number of shards: no table of ring points
exists, and one more shard takes its fair share of keys and moves no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.blocks import id_blocks

# Fixed values of the published algorithm.
_MULTIPLIER = np.uint64(2862933555777941757)
_SCALE = float(1 << 31)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key, all keys at once: every round, the keys whose next
    jump stays below ``shards`` move on; the rest have arrived."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64)
    shard = np.zeros(len(keys), dtype=np.int64)
    at = np.arange(len(keys))
    with np.errstate(over="ignore"):
        while len(at):
            state = state * _MULTIPLIER + np.uint64(1)
            step = _SCALE / ((state >> np.uint64(33)).astype(np.float64) + 1.0)
            nxt = np.floor((shard[at] + 1) * step).astype(np.int64)
            on = nxt < shards
            at, state = at[on], state[on]
            shard[at] = nxt[on]
    return shard.astype(np.int32)


def jump_shard(key: str | Column, shards: int) -> Column:
    """The shard (0 to ``shards - 1``) of an integer key; null counts as key 0.  For keys
    of other types pass a stable 64-bit hash such as ``xxhash64``."""

    @F.pandas_udf("int")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in parts:
            yield pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards))

    key = F.col(key) if isinstance(key, str) else key
    return of(F.coalesce(key.cast("long"), F.lit(0)))


def with_shard(df: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """``df`` with the shard of ``key``; no shuffle.  A column of that name is replaced."""
    return df.withColumn(name, jump_shard(key, shards))


def with_slots(rows: DataFrame, key: str, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Numbers the rows of each shard gaplessly from 0, ascending by key (null first) and
    then by the other columns.

    Meant for narrow rows.  Equal rows are counted before the shuffle and spread out again
    at the end, so that a repeated row costs no more than one.  A shard is numbered in
    ranges of keys whose sizes are summed up first, so that no task sorts a whole shard.
    """
    columns = rows.columns
    blocks = id_blocks(rows, key)
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.withColumn("_block", blocks.column(key))
    inside = Window.partitionBy(shard, "_block").orderBy(
        F.col(key).asc_nulls_first(), *[c for c in columns if c != key]
    )
    before = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        counted.groupBy(shard, "_block")
        .agg(F.sum("_n").alias("_size"))
        .select(shard, "_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    )
    placed = counted.withColumn("_first", F.sum("_n").over(inside) - F.col("_n"))
    first = F.col("_before") + F.col("_first")
    return (
        placed.join(sizes, [shard, "_block"])
        .select(*columns, F.explode(F.sequence(first, first + F.col("_n") - 1)).alias(slot))
    )


def shard_report(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): size in bytes (UTF-8 bytes plus 1; null
    text: 1), CRC-32 of the text (null: that of the empty text), shard, place in the shard,
    and the shard if there were one more.  An empty table gives an empty one; repeated rows
    get places of their own."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        jump_shard("doc_id", shards).alias("shard"),
        jump_shard("doc_id", shards + 1).alias("grown_shard"),
    )
    return with_slots(rows, "doc_id").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
