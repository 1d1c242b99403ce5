"""Groups of rows as numpy tasks: hot groups in tiles, small ones many to a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import partitions


def tiled(rows: DataFrame, key: str, member: str, size: Column, tile: int) -> DataFrame:
    """``rows`` with ``tile_a`` and ``tile_b``: a group of up to ``tile`` rows is one task's
    work; a larger one is cut into k tiles by a hash of ``member`` and every pair of tiles
    is one, so that any two members meet and no task holds more than two tiles.
    ``tile_own`` is a row's own tile."""
    k = F.ceil(size / tile).cast("int")
    own = F.pmod(F.xxhash64(member), k).cast("int")
    other = F.explode(F.sequence(F.lit(0), k - 1))
    spread = rows.withColumn("_own", own).withColumn("_other", other)
    return spread.select(
        *rows.columns,
        F.col("_own").alias("tile_own"),
        F.least("_own", "_other").alias("tile_a"),
        F.greatest("_own", "_other").alias("tile_b"),
    )


def by_group(rows: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.Table | None], schema: str) -> DataFrame:
    """``fn`` applied to each group of ``keys``; a task goes through its groups in one
    sorted stream, so that many small groups cost little."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        out: list[pa.Table] = []

        def flush() -> None:
            got = fn(pa.concat_tables(held).combine_chunks())
            held.clear()
            if got is not None and got.num_rows:
                out.append(got)

        last = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            columns = [table.column(k).to_numpy() for k in keys]
            new = np.zeros(table.num_rows, dtype=bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            first = tuple(c[0] for c in columns)
            if last is not None and first != last:
                flush()
            cuts = np.flatnonzero(new)
            for a, b in zip([0, *cuts], [*cuts, len(new)], strict=True):
                if a:
                    flush()
                held.append(table.slice(a, b - a))
            last = tuple(c[-1] for c in columns)
            if len(out) > 1000:
                yield from pa.concat_tables(out).combine_chunks().to_batches()
                out.clear()
        if held:
            flush()
        if out:
            yield from pa.concat_tables(out).combine_chunks().to_batches()

    n = partitions(rows.sparkSession)
    return rows.repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def linked_stars(n: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[np.ndarray]:
    """Connected groups of ``n`` members: ``linked(i, others)`` tells which of ``others`` i
    has a link with.  A member is only compared with those that no group has yet."""
    rest = np.arange(n)
    while len(rest):
        group, todo, rest = [rest[:1]], [int(rest[0])], rest[1:]
        while todo and len(rest):
            hit = linked(todo.pop(), rest)
            if hit.any():
                group.append(rest[hit])
                todo += rest[hit].tolist()
                rest = rest[~hit]
        if len(group) > 1:
            yield np.concatenate(group)


def stars(ids: np.ndarray, groups: Iterator[np.ndarray]) -> pa.Table | None:
    """Links (u, v) of every member of a group with its smallest."""
    u, v = [], []
    for group in groups:
        members = ids[group]
        least = members.min()
        others = members[members != least]
        u.append(others)
        v.append(np.full(len(others), least))
    if not u:
        return None
    return pa.table({"u": pa.array(np.concatenate(u)), "v": pa.array(np.concatenate(v))})
