"""Alignment of two tokenizers' tokens over the same bytes, and how often ids meet.

Places where tokens of both tokenizers end cut a text into groups.  A range of bytes knows
its tokens but not what stands before it, so it yields a fragment: tokens up to its first
common end (an open prefix), closed groups, and tokens after its last common end (an open
suffix).  Fragments of neighbouring ranges compose: what one leaves open at its end and the
next at its start becomes one group.  Composition is associative, so the ranges of a very
long text are tokenized in tasks of their own and their open ends are reduced in a tree,
while closed groups stay where they are.  Short texts are one fragment each, many to a call.

How many documents hold a pair of linked ids is summed in Spark: each block of texts sends
its distinct pairs once and gets their counts back, so the rows follow the distinct pairs of
blocks and not the links.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import textops as T
from tidemark.llm.shared import cut, partitions

#: A text of more bytes is cut into ranges; texts of a block; fragments composed at once; runs
#: of text kept by a worker.  They bound a task's memory and change no result.
RANGE_BYTES, BLOCK_BYTES, FAN = 1 << 16, 8 << 20, 16
KEPT_RUNS, KEPT_CHARS = 300_000, 1 << 24
_SHIFT = 16  # a pair of ids is one number
_MARK = "▁"
#: A single space between other characters: both tokenizers begin anew there.
_SPACE = re.compile(r"(?<=\S) (?=\S)")


@dataclass(frozen=True)
class TokenizerPair:
    """A: a byte-level BPE of the ``tokenizers`` library; B: a ``sentencepiece`` model that
    adds a space before the text.  The files are read by the driver."""

    a_json: str
    b_model: bytes

    def __reduce__(self):
        return TokenizerPair, (self.a_json, self.b_model)

    @classmethod
    def load(cls, a_path: str, b_path: str) -> TokenizerPair:
        with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
            return cls(a.read(), b.read())

    @cached_property
    def a(self) -> tokenizers.Tokenizer:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        tokenizer = tokenizers.Tokenizer.from_str(self.a_json)
        tokenizer.encode_special_tokens = True
        return tokenizer

    @cached_property
    def b(self) -> sentencepiece.SentencePieceProcessor:
        return sentencepiece.SentencePieceProcessor(model_proto=self.b_model)

    @cached_property
    def a_bytes(self) -> list[bytes]:
        """Token bytes by id.  Printable bytes stand for themselves in the vocabulary, the
        others for characters from 256 on."""
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in plain]
        of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        out = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            out[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        return out

    @cached_property
    def b_bytes(self) -> list[bytes]:
        model = self.b
        piece = model.id_to_piece
        return [
            bytes([int(piece(i)[3:5], 16)]) if model.is_byte(i) else piece(i).replace(_MARK, " ").encode()
            for i in range(model.get_piece_size())
        ]

    @cached_property
    def widths(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes))

    @cached_property
    def cuttable(self) -> bool:
        """Whether both tokenizers see what stands before and after a single space between
        other characters apart: no token of B goes on after a space, and neither changes
        the text first."""
        model, b = self.a, self.b
        pieces = (b.id_to_piece(i) for i in range(b.get_piece_size()))
        return model.normalizer is None and b.normalize("Å  ﬁ x") == f"{_MARK}Å{_MARK}{_MARK}ﬁ{_MARK}x" and not any(
            _MARK in p.lstrip(_MARK) for p in pieces
        )

    @cached_property
    def names(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Decimal ids, followed by a comma, a bar and a semicolon."""
        size = max(len(self.a_bytes), len(self.b_bytes))
        return tuple(np.array([f"{i}{mark}" for i in range(size)], object) for mark in ",|;")

    @cached_property
    def runs(self) -> _Runs:
        return _Runs(self)

    def tokens(self, units: list[bytes]) -> tuple[Tokens, np.ndarray]:
        """(tokens of all units one after the other, which units both tokenizers give back
        byte by byte); units begin with a space and others have no tokens."""
        texts = [u.decode()[1:] for u in units]
        parts = [_SPACE.split(t) if self.cuttable else [t] for t in texts]
        place = self.runs.places(parts)
        owner = np.repeat(np.arange(len(units)), [len(x) for x in parts])
        good = np.bincount(owner, ~self.runs.good[place], len(units)) == 0
        place = place[good[owner]]
        out = []
        for side, width in enumerate(self.widths):
            ids = self.runs.ids_at(place, side)
            out += [ids, np.cumsum(width[ids])]
        return Tokens(*out), good


class _Runs:
    """Runs of text between single spaces that a worker has met, with their ids: each is
    tokenized once.  Beyond ``KEPT_RUNS`` all are forgotten."""

    def __init__(self, pair: TokenizerPair) -> None:
        self.pair = pair
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.chars = 0
        self.good = np.zeros(0, bool)
        self.ids = [np.zeros(0, np.int32)] * 2
        self.ends = [np.zeros(1, np.int64)] * 2

    def places(self, parts: list[list[str]]) -> np.ndarray:
        """The number of every run, learning new ones."""
        if len(self.index) > KEPT_RUNS or self.chars > KEPT_CHARS:
            self.forget()
        index, known = self.index, len(self.index)
        place = np.fromiter((index.setdefault(x, len(index)) for p in parts for x in p), np.int64, sum(map(len, parts)))
        if len(index) > known:
            self.learn(list(islice(index, known, None)))
        return place

    def learn(self, runs: list[str]) -> None:
        a, b, said = self.pair.a, self.pair.b, [" " + x for x in runs]
        self.chars += sum(map(len, said))
        found = [[e.ids for e in a.encode_batch_fast(said, add_special_tokens=False)], b.encode(runs, num_threads=1)]
        raw, good = [x.encode() for x in said], np.ones(len(said), bool)
        for side, (lists, table) in enumerate(zip(found, (self.pair.a_bytes, self.pair.b_bytes), strict=True)):
            joined = [b"".join([table[i] for i in x]) for x in lists]
            good &= np.array([x == y for x, y in zip(joined, raw, strict=True)])
            counts = np.array([len(x) for x in lists], np.int64)
            flat = np.fromiter(chain.from_iterable(lists), np.int32, int(counts.sum()))
            self.ids[side] = np.concatenate([self.ids[side], flat])
            self.ends[side] = np.concatenate([self.ends[side], self.ends[side][-1] + np.cumsum(counts)])
        self.good = np.concatenate([self.good, good])

    def ids_at(self, place: np.ndarray, side: int) -> np.ndarray:
        """The ids of runs one after the other."""
        begins = self.ends[side][place]
        counts = self.ends[side][place + 1] - begins
        ends = np.cumsum(counts)
        return self.ids[side][np.arange(int(counts.sum())) + np.repeat(begins - ends + counts, counts)].astype(np.int64)


def _merged(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all values of two ascending arrays, which of them both have)."""
    every = np.sort(np.concatenate([a, b]), kind="stable")
    again = np.zeros(len(every), bool)
    again[1:] = every[1:] == every[:-1]
    both = np.append(again[1:], False)[~again]
    return every[~again], both


@dataclass(frozen=True)
class Tokens:
    """Ids of both tokenizers with the byte at which each ends."""

    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray

    def between(self, low: int, high: int) -> Tokens:
        """Tokens that end after ``low`` and not after ``high``."""
        i, j = np.searchsorted(self.a_end, [low, high], side="right")
        k, m = np.searchsorted(self.b_end, [low, high], side="right")
        return Tokens(self.a[i:j], self.a_end[i:j], self.b[k:m], self.b_end[k:m])

    def moved(self, by: int) -> Tokens:
        return Tokens(self.a, self.a_end + by, self.b, self.b_end + by)

    def then(self, other: Tokens) -> Tokens:
        pairs = zip(self.columns(), other.columns(), strict=True)
        return Tokens(*(np.concatenate(p) for p in pairs))

    def columns(self) -> tuple[np.ndarray, ...]:
        return self.a, self.a_end, self.b, self.b_end

    def common(self) -> np.ndarray:
        ends, both = _merged(self.a_end, self.b_end)
        return ends[both]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(end, pair of ids) of every stretch without an end of a token inside: each pair of
        overlapping tokens shares exactly one."""
        ends, _ = _merged(self.a_end, self.b_end)
        a = self.a[np.searchsorted(self.a_end, ends)]
        return ends, a << _SHIFT | self.b[np.searchsorted(self.b_end, ends)]

    def names(self, pair: TokenizerPair, common: np.ndarray) -> np.ndarray:
        """The ids as text with the marks that follow them, in order of groups."""
        comma, bar, semicolon = pair.names
        out = np.empty(len(self.a) + len(self.b), object)
        group_a, group_b = np.searchsorted(common, self.a_end), np.searchsorted(common, self.b_end)
        last_a, last_b = np.isin(self.a_end, common, assume_unique=True), np.isin(self.b_end, common, assume_unique=True)
        out[np.arange(len(self.a)) + np.searchsorted(group_b, group_a)] = np.where(last_a, bar[self.a], comma[self.a])
        out[np.arange(len(self.b)) + np.searchsorted(group_a, group_b, side="right")] = np.where(
            last_b, semicolon[self.b], comma[self.b]
        )
        return out


NONE = Tokens(*[np.zeros(0, np.int64)] * 4)


@dataclass(frozen=True)
class Fragment:
    """What a range of bytes knows of its groups; ``seams`` are groups closed by composing.
    Without a common end (``closed``) all tokens are in ``prefix``."""

    closed: bool
    prefix: Tokens
    suffix: Tokens
    seams: tuple[Tokens, ...] = ()

    def then(self, other: Fragment) -> Fragment:
        """The fragment of both ranges; associative."""
        if not self.closed:
            return Fragment(other.closed, self.prefix.then(other.prefix), other.suffix, other.seams)
        if not other.closed:
            return Fragment(True, self.prefix, self.suffix.then(other.prefix), self.seams)
        seam = self.suffix.then(other.prefix)
        return Fragment(True, self.prefix, other.suffix, (*self.seams, seam, *other.seams))

    def pack(self) -> bytes:
        parts = [self.prefix, self.suffix, *self.seams]
        columns = [pa.array([p.columns()[i] for p in parts], pa.list_(pa.int64())) for i in range(4)]
        sink = pa.BufferOutputStream()
        table = pa.table(columns, names=list("abcd")).replace_schema_metadata({"closed": str(int(self.closed))})
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        return sink.getvalue().to_pybytes()

    @classmethod
    def unpack(cls, data: bytes) -> Fragment:
        table = pa.ipc.open_stream(data).read_all()
        columns = [[np.array(x, np.int64) for x in c.to_pylist()] for c in table.columns]
        prefix, suffix, *seams = [Tokens(*x) for x in zip(*columns, strict=True)]
        return cls(table.schema.metadata[b"closed"] == b"1", prefix, suffix, tuple(seams))


def fragment(tokens: Tokens, first: bool) -> tuple[Fragment, Tokens]:
    """(fragment, tokens of its closed groups) of a range; a text's first range begins with
    a common end."""
    common = tokens.common()
    far = np.iinfo(np.int64).max
    if first:
        last = int(common[-1]) if len(common) else 0
        return Fragment(True, NONE, tokens.between(last, far)), tokens.between(0, last)
    if not len(common):
        return Fragment(False, tokens, NONE), NONE
    low, high = int(common[0]), int(common[-1])
    return Fragment(True, tokens.between(-1, low), tokens.between(high, far)), tokens.between(low, high)


def _space_between(data: bytes, at: int) -> bool:
    """Whether a single space stands at a byte between other characters."""
    if data[at] != 0x20 or at == 0 or at + 1 >= len(data):
        return False
    before = data[max(0, at - 4) : at].decode("utf-8", "ignore")[-1:]
    after = data[at + 1 : at + 5].decode("utf-8", "ignore")[:1]
    return not before.isspace() and not after.isspace()


def ranges(data: bytes, size: int = RANGE_BYTES) -> Iterator[tuple[int, int, int, int]]:
    """(low, high, from, to): ranges of bytes, each with the bytes to tokenize for the tokens
    that end in it: from the last place before where both tokenizers begin anew to the
    next behind.  Limits are fixed bytes, but only one in a run without such a place."""
    n = len(data)
    limits = [(0, 0, 0)]
    while (at := max(limits[-1][0] + size, limits[-1][2])) < n:
        left, right = at, at
        while left and not _space_between(data, left):
            left = max(data.rfind(b" ", 0, left), 0)
        while right < n and not _space_between(data, right):
            right = data.find(b" ", right + 1)
            right = n if right < 0 else right
        limits.append((at, left, right))
    limits.append((n, n, n))
    for (low, start, _), (high, _, stop) in zip(limits, limits[1:], strict=False):
        yield low, high, start, stop


BLOCK_DDL = "block long, data binary, codes array<long>, docs array<int>"
REPORT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
SUMS = ["n_a", "n_b", "n_groups", "n_links"]


def _per_document(tokens: Tokens, size: np.ndarray, pair: TokenizerPair) -> tuple[list[np.ndarray], list[str], tuple]:
    """([n_a, n_b, n_groups, n_links], digests, (document, pair of ids, links)) of documents
    whose bytes follow each other; each begins and ends with a common end."""
    n, ends = len(size), np.cumsum(size)
    common = tokens.common()
    link_end, codes = tokens.links()
    of = lambda places: np.searchsorted(ends, places)
    counts = [np.bincount(of(x), minlength=n) for x in (tokens.a_end, tokens.b_end, common, link_end)]
    names = tokens.names(pair, common)
    stop = np.cumsum(counts[0] + counts[1])
    digests = []
    for i, j in zip(stop - counts[0] - counts[1], stop, strict=True):
        digests.append(hashlib.sha256("".join(names[i:j].tolist())[:-1].encode()).hexdigest())
    keys = np.sort(of(link_end) << 32 | codes)
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    keys, times = keys[new], np.diff(new, append=len(keys))
    return counts, digests, (keys >> 32, keys & 0xFFFFFFFF, times)


class _Block:
    """Documents of a task that are counted together."""

    def __init__(self) -> None:
        self.rows, self.owner, self.codes, self.times, self.bytes, self.n = [], [], [], [], 0, 0

    def add(self, part, pair: TokenizerPair) -> None:
        texts = [None if t is None or t == "" else b" " + t.encode() for t in part.column("text").to_pylist()]
        some = [i for i, t in enumerate(texts) if t is not None]
        tokens, good = pair.tokens([texts[i] for i in some]) if some else (NONE, np.zeros(0, bool))
        known = np.array(some, np.int64)[good]
        sums = [np.zeros(len(texts), np.int64) for _ in SUMS]
        digests = np.full(len(texts), "", object)
        if len(known):
            counts, found, (owner, codes, times) = _per_document(tokens, np.array([len(texts[i]) for i in known], np.int64), pair)
            for total, c in zip(sums, counts, strict=True):
                total[known] = c
            digests[known] = found
            self.owner.append(known[owner] + self.n)
            self.codes.append(codes)
            self.times.append(times.astype(np.int32))
        columns = [part.column("doc_id"), *map(pa.array, sums), pa.array(digests, pa.string())]
        self.rows.append(pa.table(columns, names=["doc_id", *SUMS, "groups_sha256"]))
        self.n += len(texts)
        self.bytes += sum(len(t) for t in texts if t is not None)

    def row(self, block: int) -> pa.RecordBatch:
        table = pa.concat_tables(self.rows)
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        codes, place, docs = np.unique(join(self.codes), return_inverse=True, return_counts=True)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(join(self.owner), minlength=self.n))])
        lists = [place.astype(np.int32), join(self.times).astype(np.int32)]
        for name, flat in zip(("place", "times"), lists, strict=True):
            table = table.append_column(name, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)))
        sink = pa.BufferOutputStream()
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
        with pa.ipc.new_stream(sink, table.schema, options=options) as out:
            out.write_table(table.combine_chunks())
        one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, kind))
        columns = [pa.array([block]), pa.array([sink.getvalue().to_pybytes()], pa.binary()), one(codes, pa.int64()), one(docs, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, names=["block", "data", "codes", "docs"])


def _blocks(docs: DataFrame, shared) -> DataFrame:
    """Texts that are one range each, in blocks: packed rows of documents, and the block's
    distinct pairs with the number of its documents that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, block = shared.value, _Block()
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in T.sliced(batch):
                block.add(part, pair)
                if block.bytes >= BLOCK_BYTES:
                    yield block.row(number)
                    number, block = number + 1, _Block()
        if block.n:
            yield block.row(number)

    return docs.mapInArrow(run, BLOCK_DDL)


RANGE_DDL = "key string, doc_id long, number int, low long, high long, start long, data binary"
PART_DDL = "key string, doc_id long, number int, good boolean, place long, n_a long, n_b long, n_groups long, n_links long, groups string, codes array<long>, times array<int>"


def _part(tokens: Tokens, pair: TokenizerPair) -> dict:
    """A stretch of closed groups."""
    common = tokens.common()
    _, codes = tokens.links()
    codes, times = np.unique(codes, return_counts=True)
    return {
        "place": int(tokens.a_end[0]) if len(tokens.a_end) else 0, "n_a": len(tokens.a), "n_b": len(tokens.b),
        "n_groups": len(common), "n_links": int(times.sum()), "groups": "".join(tokens.names(pair, common).tolist())[:-1],
        "codes": codes, "times": times,
    }


_PART_SCHEMA = pa.schema(
    [("key", pa.string()), ("doc_id", pa.int64()), ("number", pa.int32()), ("good", pa.bool_())]
    + [(n, pa.int64()) for n in ("place", *SUMS)]
    + [("groups", pa.string()), ("codes", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))]
)


def _range_rows(docs: DataFrame) -> DataFrame:
    """Ranges of long texts with the bytes around them, each of equal rows' once: ``copies``
    says how many equal rows there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.string()), ("doc_id", pa.int64()), ("number", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("start", pa.int64()), ("data", pa.binary())])
        for batch in batches:
            for key, doc_id, text, cuttable in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = b" " + text.encode()
                for i, (low, high, start, stop) in enumerate(ranges(data) if cuttable else [(0, len(data), 0, len(data))]):
                    row = [key, doc_id, i, low, high, start, data[start:stop]]
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    same = ["key", "doc_id", "number", "low", "high", "start"]
    rows = docs.mapInArrow(run, RANGE_DDL)
    return rows.groupBy(*same).agg(F.count(F.lit(1)).alias("copies"), F.max("data").alias("data"))


def _fragments(rows: DataFrame, shared) -> DataFrame:
    """Closed groups of every range, and its open ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = shared.value
        schema = _PART_SCHEMA.append(pa.field("copies", pa.int64())).append(pa.field("edges", pa.binary()))
        for batch in batches:
            for row in batch.to_pylist():
                tokens, good = pair.tokens([row["data"]])
                mine = tokens.moved(row["start"]).between(row["low"], row["high"])
                edges, closed = fragment(mine, row["number"] == 0)
                out = {k: row[k] for k in ("key", "doc_id", "number", "copies")} | {"good": bool(good[0]), "edges": edges.pack()}
                yield pa.RecordBatch.from_pylist([out | _part(closed, pair)], schema=schema)

    return rows.mapInArrow(run, PART_DDL + ", copies long, edges binary")


def _seams(parts: DataFrame, shared) -> DataFrame:
    """Groups that lie over limits of ranges: the open ends of each text reduced in a tree,
    ``FAN`` neighbours at a time."""
    heights = parts.agg(F.max("number")).first()[0] or 0
    edges = parts.select("key", "number", "edges")

    def compose(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["number"])
        whole = Fragment.unpack(rows[0]["edges"])
        for row in rows[1:]:
            whole = whole.then(Fragment.unpack(row["edges"]))
        kinds = [pa.string(), pa.int32(), pa.binary()]
        values = [rows[0]["key"], rows[0]["number"] // FAN, whole.pack()]
        return pa.table([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=["key", "number", "edges"])

    while heights:
        heights //= FAN
        up = edges.groupBy("key", F.floor(F.col("number") / FAN).alias("up"))
        edges = up.applyInArrow(compose, "key string, number int, edges binary")

    def closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                for seam in Fragment.unpack(row["edges"]).seams:
                    yield pa.RecordBatch.from_pylist([{"key": row["key"], "good": True} | _part(seam, pair)], schema=_PART_SCHEMA)

    return edges.mapInArrow(closed, PART_DDL)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of every text's groups, whose parts follow each other in order."""
    current, digest, any_ = None, None, False

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([current]), pa.array([digest.hexdigest()])], names=["key", "groups_sha256"])

    for batch in batches:
        for key, groups in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != current:
                if current is not None:
                    yield row()
                current, digest, any_ = key, hashlib.sha256(), False
            if groups:
                digest.update(((";" if any_ else "") + groups).encode())
                any_ = True
    if current is not None:
        yield row()


def _looked_up(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of a block with the sums of their pairs' counts."""
    names = [c.split()[0] for c in REPORT.split(", ")]
    out = []
    place = right.column("place").to_numpy()
    counts, best = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
    counts[place], best[place] = right.column("n").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
    for data in left.column("data"):
        table = pa.ipc.open_stream(pa.py_buffer(data.as_buffer())).read_all().combine_chunks()
        lists = table.column("place").combine_chunks()
        owner = np.repeat(np.arange(table.num_rows), np.diff(lists.offsets.to_numpy()))
        at, times = lists.flatten().to_numpy(), table.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
        totals = [np.zeros(table.num_rows, np.int64) for _ in range(2)]
        for total, values in zip(totals, (times * best[at], times * counts[at]), strict=True):
            np.add.at(total, owner, values)
        for name, total in zip(("n_best", "count_sum"), totals, strict=True):
            table = table.append_column(name, pa.array(total))
        out.append(table.select(names))
    return pa.concat_tables(out)


def align(docs: DataFrame, pair: TokenizerPair) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(blocks, parts, counts) of ``docs`` (doc_id, text): short documents in packed blocks,
    long ones as parts with their groups in order of ``place``, and for every linked pair of
    ids (``code`` is A's id times 65,536 and B's) the number ``n`` of documents that hold it,
    with whether it is its A id's ``best``.

    All rows count, repeated ones too.  A text that is null, empty, or not given back byte
    by byte by both tokenizers has no tokens.  Other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pair)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    long_ = F.coalesce(F.octet_length("text") >= RANGE_BYTES, F.lit(False))
    blocks = cut(_blocks(rows.where(~long_), shared), "blocks")

    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    keyed = rows.where(long_).select(F.sha2(F.encode(name, "UTF-8"), 256).alias("key"), "doc_id", "text", F.lit(pair.cuttable).alias("cuttable"))
    found = cut(_fragments(_range_rows(keyed), shared), "fragments")
    bad = found.where("NOT good").select("key").distinct()
    found_good = found.join(bad, "key", "left_anti")
    whose = found_good.where("number = 0").select("key", F.col("doc_id").alias("of"), "copies")
    seams = _seams(found_good, shared).drop("doc_id").join(whose, "key").withColumnRenamed("of", "doc_id")
    parts = cut(found_good.drop("edges").unionByName(seams.select(*found.drop("edges").columns)), "parts")

    held = parts.select("key", "copies", F.explode("codes").alias("code")).distinct().select("code", F.col("copies").alias("n"))
    pairs = blocks.select(F.explode(F.arrays_zip("codes", "docs")).alias("p")).select(F.col("p.codes").alias("code"), F.col("p.docs").cast("long").alias("n"))
    counts = pairs.unionByName(held).groupBy("code").agg(F.sum("n").alias("n"))
    # An A id has at most as many pairs as B has ids.
    top = F.max("n").over(Window.partitionBy(F.shiftright("code", _SHIFT)))
    counts = cut(counts.select("code", "n", (F.col("n") == top).alias("best")), "pairs")
    nothing = found.join(bad, "key").where("number = 0").select("key", "doc_id", "copies")
    return blocks, parts.unionByName(nothing, allowMissingColumns=True), counts


def alignment_report(docs: DataFrame, pair: TokenizerPair) -> DataFrame:
    """One row per row of ``docs``: tokens, groups, links, links whose pair is the best of
    its A id, the sum of all links' counts, and the digest of the groups.

    A digest is one value, so the parts of a long text are read in order by one task, one
    at a time.  Without tokens all numbers are zero and the digest is empty.  An empty table
    gives an empty one.
    """
    blocks, parts, counts = align(docs, pair)
    n = partitions(docs.sparkSession)
    asked = blocks.select(F.col("block").alias("of"), F.posexplode("codes").alias("place", "code")).join(counts, "code")
    asked = asked.select("of", "place", "n", "best")
    short = blocks.select("block", "data").groupBy("block").cogroup(asked.groupBy("of")).applyInArrow(_looked_up, REPORT)

    links = parts.select("key", F.explode(F.arrays_zip("codes", "times")).alias("p")).select("key", F.col("p.codes").alias("code"), F.col("p.times").cast("long").alias("times"))
    sums = links.join(counts, "code").groupBy("key").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    totals = parts.groupBy("key", "doc_id", "copies").agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in SUMS])
    ordered = parts.where("groups IS NOT NULL").repartition(n, "key").sortWithinPartitions("key", "place").select("key", "groups")
    digests = ordered.mapInArrow(_digests, "key string, groups_sha256 string")
    long_ = totals.join(sums, "key", "left").join(digests, "key", "left")
    each = long_.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return short.unionByName(
        each.select(
            "doc_id",
            *SUMS,
            F.coalesce("n_best", F.lit(0).cast("long")).alias("n_best"),
            F.coalesce("count_sum", F.lit(0).cast("long")).alias("count_sum"),
            F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
        )
    )
