"""Removal of repeated passages by fixed-block anchors.

Every text is cut into non-overlapping reference blocks of ``anchor`` words, and every
rolling window of ``anchor`` words probes them.  A passage of ``window >= 2 * anchor``
words that occurs twice holds a whole reference block of its earlier place, so both places
are hit.  Around the hits the windows of ``window`` words are compared over the whole
corpus; neighbouring repeated windows join to maximal exact repeats, and all words that a
repeat covers are removed at every place but the first.

Probes and windows are 64-bit hashes, compared inside a bucket chosen by a second,
hash of its own words' hashes, so that the bits grow with the data.  Both comparisons exchange one
packed row per block and bucket (see ``blocks``), whatever the number of copies: a passage
that a third of all documents share is one value per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm import textops as T
from tidemark.llm.blocks import fit_blocks, from_planes, pack, planes, unpack

WINDOW, ANCHOR = 20, 10
_SECOND = 0x5851F42D4C957F2D
_SENT = "bucket int, block int, keys binary, flags binary"
_ANSWER = "block int, bucket int, bits binary"
RESULT = (
    "doc_id long, n_words long, n_removed long, kept_sha256 string,"
    " removed array<struct<first:long,words:long>>"
)


class _BlockWords:
    """The words of the texts of one block; texts shorter than a window have no hashes."""

    def __init__(self, rows: pa.Table) -> None:
        hashes, others, counts = [], [], []
        for part in T.sliced(rows):
            buf, off = T.text_bytes(part.column("text"))
            starts, stops, n = T.word_bounds(buf, off)
            hashes.append(T.word_hashes(buf, starts, stops))
            others.append(T.word_hashes(buf, starts, stops, seed=1))
            counts.append(n)
        none = np.zeros(0, np.int64)
        self.counts = np.concatenate(counts) if counts else none
        self.hashes = np.concatenate(hashes) if hashes else none.astype(np.uint64)
        self.others = np.concatenate(others) if others else none.astype(np.uint64)
        self.firsts = np.cumsum(self.counts) - self.counts

    def windows(self, k: int, buckets: int, within: np.ndarray | None = None):
        """(first word, hash, bucket) of the windows of ``k`` words, if ``within`` says so."""
        starts = T.window_starts(self.counts, k)
        if within is not None:
            starts = starts[within[starts]]
        value = T.window_hashes(self.hashes, starts, k)
        second = T.window_hashes(self.others, starts, k, salt=_SECOND)
        return starts, value, ((second >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def _sorted_sets(value: np.ndarray, bucket: np.ndarray):
    """Yields (bucket, sorted distinct values, positions in the input by value, index of
    the first of each distinct value among them); the same for the same input."""
    order = np.lexsort((value, bucket))
    value, bucket = value[order], bucket[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(bucket)], strict=True):
        if b > a:
            run = value[a:b]
            new = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
            yield int(bucket[a]), run[new], order[a:b], new


def _probe_sets(words: _BlockWords, anchor: int, window: int, buckets: int):
    """The probes of a block as 32-bit keys, with what the block knows about each: a
    reference block is among them, or there are several of them."""
    enough = np.repeat(words.counts >= window, words.counts)
    starts, value, bucket = words.windows(anchor, buckets, within=enough)
    place = starts - np.repeat(words.firsts, words.counts)[starts]
    value = (value >> np.uint64(32)).astype(np.uint32)
    for b, keys, order, new in _sorted_sets(value, bucket):
        anchored = np.maximum.reduceat(place[order] % anchor == 0, new)
        several = np.diff(new, append=len(order)) > 1
        yield b, keys, starts[order], new, anchored, several


def _send_probes(anchor: int, window: int, buckets: int):
    def send(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        out = [
            (b, planes(keys), np.packbits(anchored).tobytes())
            for b, keys, _, _, anchored, _ in _probe_sets(
                _BlockWords(unpack(table)), anchor, window, buckets
            )
        ]
        return _sent(block, out)

    return send


def _sent(block: int, out: list[tuple[int, bytes, bytes]]) -> pa.Table:
    return pa.table(
        {
            "bucket": pa.array([x[0] for x in out], pa.int32()),
            "block": pa.array([block] * len(out), pa.int32()),
            "keys": pa.array([x[1] for x in out], pa.binary()),
            "flags": pa.array([x[2] for x in out], pa.binary()),
        }
    )


def _answer(dtype, first_only: bool):
    """Compares the sets of one bucket.

    Probes: a key is hit if two blocks hold it and one of them as a reference block.
    Windows (``first_only``): a value is marked in all blocks but the first that holds it.
    """

    def answer(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        keys = [from_planes(x.as_buffer(), dtype) for x in table.column("keys")]
        sizes = np.array([len(k) for k in keys])
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")  # stable: ascending blocks
        run = every[order]
        new = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        length = np.diff(new, append=len(run))
        marked = np.zeros(len(run), dtype=bool)
        if first_only:
            later = np.ones(len(run), dtype=bool)
            later[new] = False
            marked[order] = later
        else:
            flags = np.concatenate(
                [
                    np.unpackbits(np.frombuffer(f.as_buffer(), np.uint8), count=n).astype(bool)
                    for f, n in zip(table.column("flags"), sizes, strict=True)
                ]
            )
            hit = np.maximum.reduceat(flags[order], new) & (length > 1)
            marked[order] = np.repeat(hit, length)
        bits, at = [], 0
        for n in sizes:
            part = marked[at : at + n]
            bits.append(np.packbits(part).tobytes() if part.any() else None)
            at += n
        got = np.array([b is not None for b in bits])
        return pa.table(
            {
                "block": table.column("block"),
                "bucket": table.column("bucket"),
                "bits": pa.array(bits, pa.binary()),
            }
        ).filter(pa.array(got))

    return answer


def _bits(answers: pa.Table) -> dict[int, bytes]:
    return dict(
        zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist(), strict=True)
    )


def _marks(bits: bytes | None, n: int) -> np.ndarray:
    if bits is None:
        return np.zeros(n, dtype=bool)
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)


def _candidates(words: _BlockWords, answers: pa.Table, anchor: int, window: int, buckets: int):
    """Which words start a window that holds a hit."""
    bits = _bits(answers)
    hit = np.zeros(len(words.hashes) + 1, dtype=np.int32)
    for b, keys, starts, new, anchored, several in _probe_sets(words, anchor, window, buckets):
        good = _marks(bits.get(b), len(keys)) | (anchored & several)
        hit[starts[np.repeat(good, np.diff(new, append=len(starts)))]] = 1
    total = np.concatenate([[0], np.cumsum(hit)])
    n = len(words.hashes)
    to = np.minimum(np.arange(n) + window - anchor + 1, n)
    return total[to] > total[:n]


def _send_windows(anchor: int, window: int, buckets: int):
    def send(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if texts.num_rows == 0:
            return _sent(0, [])
        block = texts.column("block")[0].as_py()
        words = _BlockWords(unpack(texts))
        wanted = _candidates(words, answers, anchor, window, buckets)
        starts, value, bucket = words.windows(window, buckets, within=wanted)
        sets = _sorted_sets(value, bucket)
        # Which windows are candidates is told along, as the last step needs it again.
        out = [(b, planes(keys), b"") for b, keys, _, _ in sets]
        if len(starts):
            out.append((-1 - block, b"", np.packbits(wanted).tobytes()))
        return _sent(block, out)

    return send


def _answer_windows(table: pa.Table) -> pa.Table:
    """As ``_answer``; a negative bucket is one block's own note, returned as it is."""
    if table.column("bucket")[0].as_py() < 0:
        return table.select(["block", "bucket", "flags"]).rename_columns(["block", "bucket", "bits"])
    return _answer(np.uint64, True)(table)


def _spans(covered: np.ndarray, counts: np.ndarray) -> list[list[dict]]:
    """Per text, the runs of covered words as (first word, number of words)."""
    out = []
    at = 0
    for n in counts:
        part = np.concatenate([[False], covered[at : at + n], [False]])
        edges = np.flatnonzero(part[1:] != part[:-1])
        out.append(
            [{"first": int(a), "words": int(b - a)} for a, b in zip(edges[::2], edges[1::2], strict=True)]
        )
        at += n
    return out


def _kept(window: int, buckets: int, texts: pa.Table, answers: pa.Table):
    """Of one block: (rows, words per text, words removed per text, their spans, per text
    the kept words)."""
    rows = unpack(texts)
    words = _BlockWords(rows)
    n = len(words.hashes)
    wanted, bits = np.zeros(n, dtype=bool), {}
    for bucket, data in _bits(answers).items():
        if bucket < 0:
            wanted = _marks(data, n)
        else:
            bits[bucket] = data
    starts, value, bucket = words.windows(window, buckets, within=wanted)
    later = np.zeros(len(starts), dtype=bool)
    for b, keys, order, new in _sorted_sets(value, bucket):
        inner = np.ones(len(order), dtype=bool)
        inner[new] = False
        again = np.repeat(_marks(bits.get(b), len(keys)), np.diff(new, append=len(order)))
        later[order] = again | inner
    delta = np.zeros(n + 1, dtype=np.int64)
    np.add.at(delta, starts[later], 1)
    np.add.at(delta, starts[later] + window, -1)
    covered = np.cumsum(delta[:-1]) > 0
    spans = _spans(covered, words.counts)
    removed = [sum(s["words"] for s in x) for x in spans]
    kept, at = [], 0
    for part in T.sliced(rows):
        buf, off = T.text_bytes(part.column("text"))
        begin, end, count = T.word_bounds(buf, off)
        raw, first = buf.tobytes(), 0
        for i, m in enumerate(count):
            if removed[at + i]:
                place = words.firsts[at + i]
                keep = np.flatnonzero(~covered[place : place + m]) + first
                kept.append([raw[a:b] for a, b in zip(begin[keep], end[keep], strict=True)])
            else:
                kept.append(raw[off[i] : off[i + 1]].split())
            first += m
        at += len(count)
    return rows, words.counts, removed, spans, kept


def _report(window: int, buckets: int):
    span = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))

    def report(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if texts.num_rows == 0:
            ids = counts = removed = digests = spans = []
        else:
            rows, counts, removed, spans, kept = _kept(window, buckets, texts, answers)
            ids = rows.column("doc_id")
            digests = [hashlib.sha256(b" ".join(k)).hexdigest() for k in kept]
        return pa.table(
            {
                "doc_id": ids if len(ids) else pa.array([], pa.int64()),
                "n_words": pa.array(counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
                "removed": pa.array(spans, span),
            }
        )

    return report


def _replace(window: int, buckets: int, columns: list[str], schema: pa.Schema):
    def replace(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if texts.num_rows == 0:
            return schema.empty_table()
        rows, _, removed, _, kept = _kept(window, buckets, texts, answers)
        old = rows.column("text").to_pylist()
        new = [
            b" ".join(k).decode("utf-8", "replace") if r else t
            for k, r, t in zip(kept, removed, old, strict=True)
        ]
        out = {c: rows.column(c) for c in columns}
        out["text"] = pa.array(new, pa.string())
        if "n_chars" in out:
            chars = rows.column("n_chars").to_pylist()
            chars = [len(t) if r else c for t, r, c in zip(new, removed, chars, strict=True)]
            out["n_chars"] = pa.array(chars, rows.schema.field("n_chars").type)
        return pa.table(out)

    return replace


def _run(
    docs: DataFrame, window: int, anchor: int, finish: Callable, schema: str, *more: str
) -> DataFrame:
    if window < 2 * anchor - 1:
        raise ValueError("a window must hold a whole reference block wherever it lies")
    blocks = fit_blocks(docs)
    buckets = blocks.buckets
    texts = pack(docs, blocks, *more)
    hits = (
        texts.groupBy("block")
        .applyInArrow(_send_probes(anchor, window, buckets), _SENT)
        .groupBy("bucket")
        .applyInArrow(_answer(np.uint32, False), _ANSWER)
    )
    later = (
        texts.groupBy("block")
        .cogroup(hits.groupBy("block"))
        .applyInArrow(_send_windows(anchor, window, buckets), _SENT)
        .groupBy("bucket")
        .applyInArrow(_answer_windows, _ANSWER)
    )
    return (
        texts.groupBy("block")
        .cogroup(later.groupBy("block"))
        .applyInArrow(finish(window, buckets), schema)
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its words, the words removed, the digest
    of the kept words joined by one space, and the spans of removed words.

    A word goes if a window of ``window`` words over it is a word sequence that also starts
    earlier: at a smaller doc_id, or earlier in the same document.  Null and empty texts
    have no words.  A null doc_id counts as the smallest.  Rows that share a doc_id count
    in the order of their texts, the second of two equal rows as the later copy.  Other
    columns of ``docs`` are not looked at.  An empty table gives an empty one.
    """
    return _run(docs, window, anchor, _report, RESULT)


def without_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` with the same rows and columns.  Texts that lose words hold the kept ones,
    joined by one space, and ``n_chars``, if there is one, is counted anew; other texts
    stay as they are.  Rules as for ``remove_repeats``."""
    more = [c for c in docs.columns if c not in ("doc_id", "text")]
    shape = docs.select(docs["doc_id"].cast("long"), "text", *more)
    arrow = to_arrow_schema(shape.schema)

    def finish(window: int, buckets: int):
        return _replace(window, buckets, shape.columns, arrow)

    out = _run(docs, window, anchor, finish, shape.schema, *more)
    return out.select(*[out[c].cast(docs.schema[c].dataType) for c in docs.columns])
