"""Texts in blocks of neighbouring documents, and an exchange of sets between blocks.

Some operators need every block of texts to ask about its words or windows in all other
blocks.  Sending one row per window would move many times the text.  Instead a block
sends, for each bucket of hash values, the sorted distinct values it holds as one packed
row; a bucket answers each block with one packed row aligned to that list; and the block,
meeting its texts again in the same exchange, works the list out anew to read the answer.
Nothing depends on the order in which rows arrive.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import partitions

BLOCK_BYTES = 16 << 20
#: Text whose words or windows make one bucket of hashes: what a task compares.
BUCKET_BYTES = 64 << 20
FLUSH_BYTES = 8 << 20
PACKED = "block int, data binary"


@dataclass(frozen=True)
class Blocks:
    """Ranges of ``doc_id``: a block holds the ids up to and with its bound, and ids
    that are null belong to the first.  Rows of one id share a block."""

    bounds: tuple[int, ...]
    #: Buckets for an exchange of sets: by bytes of text, not by blocks, so that packed rows
    #: hold more the larger the corpus is.
    buckets: int = 1

    @property
    def count(self) -> int:
        return len(self.bounds) + 1

    def of(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(np.asarray(self.bounds, dtype=np.int64), ids, side="left")

    def column(self, key: str) -> Column:
        """The block of a column of ids."""

        @F.pandas_udf("int")
        def block(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for ids in parts:
                yield pd.Series(self.of(ids.to_numpy(np.int64)).astype(np.int32))

        return block(F.coalesce(F.col(key).cast("long"), F.lit(np.iinfo(np.int64).min)))

    def native(self, key: str) -> Column:
        """As ``column``, by built-in expressions: bounds in rows of about the square root
        of their number; whole rows below the id are counted, then bounds in the next."""
        width = max(1, math.isqrt(len(self.bounds)))
        lines = [self.bounds[i : i + width] for i in range(0, len(self.bounds), width)]
        if not lines:
            return F.lit(0)
        of = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
        ids = F.coalesce(F.col(key).cast("long"), F.lit(np.iinfo(np.int64).min))
        full = F.size(F.filter(of([x[-1] for x in lines]), lambda b: b < ids))
        line = F.coalesce(F.get(F.array(*[of(x) for x in lines]), full), of([]).cast("array<bigint>"))
        return F.least(full * width, F.lit(len(self.bounds))) + F.size(F.filter(line, lambda b: b < ids))


def id_blocks(rows: DataFrame, key: str, n: int | None = None) -> Blocks:
    """``n`` blocks of about equal numbers of rows; by default two for each shuffle
    partition.  Only the bounds come to the driver."""
    n = n or 2 * partitions(rows.sparkSession)
    steps = [i / n for i in range(1, n)] or [0.5]
    ids = F.col(key).cast("long")
    found = rows.agg(F.percentile_approx(ids, steps, 20 * n).alias("bounds")).first()[0]
    return Blocks(tuple(sorted(set(found or ()))))


def fit_blocks(docs: DataFrame) -> Blocks:
    """Blocks of documents: two for each shuffle partition, or more if they would hold over
    ``BLOCK_BYTES`` of text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    few = partitions(docs.sparkSession)
    n = max(2 * few, -(-size // BLOCK_BYTES))
    return replace(id_blocks(docs, "doc_id", n), buckets=max(few, -(-size // BUCKET_BYTES)))


def _compress(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table.combine_chunks(), max_chunksize=1 << 20)
    return sink.getvalue().to_pybytes()


def pack(docs: DataFrame, blocks: Blocks, *more: str) -> DataFrame:
    """(block, data): compressed rows (doc_id, text, ...) of one block; a block has many."""

    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        ids = table.column("doc_id").combine_chunks()
        block = blocks.of(np.asarray(pc.fill_null(ids, np.iinfo(np.int64).min)))
        order = np.argsort(block, kind="stable")
        table, block = table.take(pa.array(order)), block[order]
        cuts = np.flatnonzero(np.diff(block)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(block)], strict=True):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(block[a])], pa.int32()),
                    pa.array([_compress(table.slice(a, b - a))], pa.binary()),
                ],
                names=["block", "data"],
            )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(batch)
            size += batch.nbytes
            if size >= FLUSH_BYTES:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *more)
    return rows.mapInArrow(packed, PACKED)


def unpack(table: pa.Table) -> pa.Table:
    """The rows of a block in ascending (doc_id, text), nulls first."""
    parts = [
        pa.ipc.open_stream(pa.py_buffer(x.as_buffer())).read_all() for x in table.column("data")
    ]
    rows = pa.concat_tables(parts)
    order = pc.sort_indices(
        rows, sort_keys=[("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start"
    )
    return rows.take(order)


def planes(values: np.ndarray) -> bytes:
    """Sorted unsigned values as differences, byte by byte: the high bytes are mostly
    zero and compress away."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(len(values), -1).T).tobytes()


def from_planes(data, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    raw = np.frombuffer(data, np.uint8).reshape(width, -1)
    steps = np.ascontiguousarray(raw.T).reshape(-1).view(dtype)
    return np.cumsum(steps, dtype=dtype)
