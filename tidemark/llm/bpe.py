"""Byte-level BPE encoding and decoding by DuckDB inside each Spark task.

A text is split into pieces by the usual pattern; the distinct pieces that a worker has
not met become token-position rows of a recursive DuckDB query.  Every round joins
neighbouring tokens with the merge table, finds the lowest rank of each piece, and
contracts that pair from the left wherever it occurs in the piece; rows that no pair
matches any more leave the recursion.  Decoding is a join with the vocabulary and an
aggregation ordered by position.

A long piece is merged in overlapping windows, which are pieces of their own to the query.
Tokens are those of the whole if every two neighbours are what their bytes alone merge to,
so two windows are joined where both begin the same token; where they nowhere do, they
become one window.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textops as T
from tidemark.llm.shared import keeps

# Pieces and their bytes given to one recursive query, ids given to one decoding query, and
# pieces and their bytes kept by a worker: they bound memory and change no result.
PIECES, PIECE_BYTES, IDS, KEPT_PIECES, KEPT_BYTES = 60_000, 1_000_000, 1_500_000, 1_500_000, 1 << 26
#: Windows of a long piece.  Powers of two, as runs of one character merge to such tokens.
WINDOW, STRIDE = 192, 128
_SHIFT = 20

# A recursive table keeps the present token of every place; a round sends only the places it
# changes, a contracted pair's second one as -1.
ENCODE = f"""
WITH RECURSIVE step(place, piece, id, len) USING KEY (place) AS (
  SELECT place, piece, id, 1 FROM start
  UNION (
    WITH live AS MATERIALIZED (
      SELECT r.* FROM recurring.step r SEMI JOIN step s ON s.piece = r.piece WHERE r.id >= 0
    ), pairs AS MATERIALIZED (
      SELECT a.piece, a.place, m.id, m.len, m.left_len, m.twin
      FROM live a JOIN live b ON b.place = a.place + a.len
      JOIN merges m ON m.pair = (a.id::BIGINT << {_SHIFT}) | b.id
    ), best AS MATERIALIZED (
      SELECT piece, min(id) AS id FROM pairs GROUP BY piece
    ), found AS MATERIALIZED (
      SELECT p.* FROM pairs p JOIN best b ON b.piece = p.piece AND b.id = p.id
    ), taken AS MATERIALIZED (
      SELECT piece, place, id, len, left_len FROM found WHERE NOT twin
      UNION ALL  -- a run of one token: its first and second, third and fourth, ...
      SELECT piece, place, id, len, left_len
      FROM (SELECT *, (place - min(place) OVER (PARTITION BY piece, run)) // left_len % 2 = 0 AS even
            FROM (SELECT *, place - left_len * row_number() OVER (PARTITION BY piece ORDER BY place) AS run
                  FROM found WHERE twin))
      WHERE even
    )
    SELECT place, piece, id, len FROM taken
    UNION ALL SELECT place + left_len, piece, -1, 0 FROM taken
  )
)
SELECT piece, id FROM step WHERE id >= 0 ORDER BY place
"""

DECODE = """
SELECT text, string_agg(v.bytes, '' ORDER BY place) AS bytes
FROM ids JOIN vocabulary v ON v.id = ids.id GROUP BY text
"""


@dataclass(frozen=True)
class Vocabulary:
    """Token bytes by rank, and the pattern of pieces."""

    tokens: tuple[bytes, ...]

    def __reduce__(self):
        return Vocabulary, (self.tokens,)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """From a rank file, read by the driver: lines of base64 token and rank."""
        ranks = {}
        with open(path, "rb") as lines:
            for line in lines:
                token, _, rank = line.strip().partition(b" ")
                if rank:
                    ranks[int(rank)] = base64.b64decode(token)
        if sorted(ranks) != list(range(len(ranks))):
            raise ValueError("ranks must run from 0 without gaps")
        return cls(tuple(ranks[i] for i in range(len(ranks))))

    @cached_property
    def ranks(self) -> dict[bytes, int]:
        return {t: i for i, t in enumerate(self.tokens)}

    @cached_property
    def lengths(self) -> np.ndarray:
        return np.array([len(t) for t in self.tokens], np.int64)

    @cached_property
    def connection(self) -> duckdb.DuckDBPyConnection:
        """An in-memory database of one thread with the merge table and the vocabulary."""
        con = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        con.execute("SET preserve_insertion_order = false")
        ranks = self.ranks
        merges = [
            (ranks[t[:i]] << _SHIFT | ranks[t[i:]], r, len(t), i, t[:i] == t[i:])
            for t, r in ranks.items()
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        ]
        names = ["pair", "id", "len", "left_len", "twin"]
        columns = zip(*merges, strict=True) if merges else [[]] * 5
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()]
        rows = pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
        con.register("given", rows)
        con.execute("CREATE TABLE merges AS FROM given")
        # Bytes as characters of the same number, as text is what can be put together.
        latin = [t.decode("latin-1") for t in self.tokens]
        ids = pa.array(np.arange(len(latin), dtype=np.int32))
        con.register("given", pa.table({"id": ids, "bytes": pa.array(latin)}))
        con.execute("CREATE TABLE vocabulary AS FROM given")
        con.unregister("given")
        return con


_CLASS: dict[str, np.ndarray] = {}
_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 4


def _classes() -> np.ndarray:
    """The class of every code point, as the pattern's classes see it."""
    if "of" not in _CLASS:
        every = "".join(map(chr, [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]))
        of = np.full(0x110000, _OTHER, dtype=np.uint8)
        for code, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
            for m in regex.finditer(pattern, every):
                a, b = m.span()
                gap = lambda i: i + 0x800 if i >= 0xD800 else i
                of[gap(a) : gap(b - 1) + 1] = code
        _CLASS["of"] = of
    return _CLASS["of"]


def piece_starts(points: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin, given all their code points and the texts' offsets.

    The same pieces as the pattern
    ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`` finds,
    for all texts at once: runs of one class, a space before a run belongs to it, the last
    of several white spaces before a run stands alone otherwise, and a lone apostrophe
    takes a contraction's letters.
    """
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = _classes()[points]
    first = np.zeros(n + 1, dtype=bool)
    first[off] = True
    run = first[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    text_end = first[1:]
    start = run.copy()
    # The last white space before something else is a piece of its own,
    space = kind == _SPACE
    last_space = space & ~text_end
    last_space[:-1] &= ~space[1:]
    last_space[-1:] = False
    start |= last_space
    # or, if it is a plain space, the beginning of what follows.
    joins = np.zeros(n, dtype=bool)
    joins[1:] = last_space[:-1] & (points[:-1] == 0x20)
    start &= ~joins
    # Contractions: an apostrophe that begins a piece, with the letters after it.
    quote = np.flatnonzero((points == 0x27) & start & ~text_end)
    if len(quote):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = padded[quote + 1], padded[quote + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        inside = np.ones(len(quote), dtype=bool)
        inside[:] = ~text_end[np.minimum(quote + 1, n - 1)]
        pair = (one.astype(np.int64) << 21) | two
        long = np.isin(pair, [(ord(a) << 21) | ord(b) for a, b in ("re", "ve", "ll")]) & inside & ~short
        start[quote[short] + 1] = False
        start[quote[long] + 1] = False
        after = np.concatenate([quote[short] + 2, quote[long] + 3])
        after = after[after < n]
        start[after] = True
    return np.flatnonzero(start)


class Encoder:
    """Pieces met so far, by hash, with their bytes and ids; bounded by ``KEPT_PIECES`` and
    ``KEPT_BYTES``."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.bytes = np.zeros(256, dtype=np.int32)
        for i in range(256):
            self.bytes[i] = vocabulary.ranks[bytes([i])]
        self.seed = 0
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        # Per piece: where its ids begin and how many, where its bytes begin and how many.
        self.spots = np.zeros((4, 0), np.int64)
        self.ids = np.zeros(0, np.int32)
        self.held = np.zeros(0, np.uint8)

    def _query(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each piece) by the recursive query."""
        sizes = np.array([len(p) for p in pieces])
        flat = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        # A free place between pieces keeps them apart.
        start = pa.table({"piece": piece, "place": np.arange(len(flat), dtype=np.int64) + piece, "id": flat})
        con = self.vocabulary.connection
        con.register("start", start)
        found = con.sql(ENCODE).to_arrow_table()
        con.unregister("start")
        owner = found.column("piece").to_numpy()
        order = np.argsort(owner, kind="stable")
        return found.column("id").to_numpy()[order], np.bincount(owner, minlength=len(pieces))

    def _by_parts(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of every piece, in queries of bounded size."""
        out, at = [], 0
        while at < len(pieces):
            to, size = at, 0
            while to < len(pieces) and to - at < PIECES and (to == at or size + len(pieces[to]) <= PIECE_BYTES):
                size += len(pieces[to])
                to += 1
            ids, counts = self._query(pieces[at:to])
            out += np.split(ids, np.cumsum(counts)[:-1])
            at = to
        return out

    def _ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.vocabulary.lengths[ids])

    def _windowed(self, piece: bytes) -> np.ndarray:
        """The ids of a long piece."""
        n = len(piece)
        lows = list(range(0, max(n - WINDOW, 0) + STRIDE, STRIDE))
        spans = [(a, min(a + WINDOW, n)) for a in lows if a == 0 or a + WINDOW - STRIDE < n]
        known: dict[tuple[int, int], np.ndarray] = {}
        while True:
            new = [x for x in spans if x not in known]
            known |= zip(new, self._by_parts([piece[a:b] for a, b in new]), strict=True)
            joined, apart, from_ = [], [], 0
            for i, (span, after) in enumerate(zip(spans, [*spans[1:], None], strict=True)):
                ids = known[span]
                ends = span[0] + self._ends(ids)
                to = n
                if after:
                    starts = np.append(span[0], ends[:-1])
                    others = after[0] + self._ends(known[after])
                    mine = starts << 32 | ends
                    same = np.isin(mine, np.append(after[0], others[:-1]) << 32 | others)
                    meets = starts[same & (starts >= from_)]
                    if not len(meets):
                        apart.append(i)
                        from_ = after[0]
                        continue
                    to = int(meets[len(meets) // 2])
                joined.append(ids[(ends > from_) & (ends <= to)])
                from_ = to
            if not apart:
                return np.concatenate(joined)
            spans = _merged_spans(spans, set(apart))

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each piece)."""
        ranks = self.vocabulary.ranks
        out = [np.array([ranks[p]], np.int32) if p in ranks else None for p in pieces]
        short = [i for i, p in enumerate(pieces) if out[i] is None and len(p) <= WINDOW]
        for i, ids in zip(short, self._by_parts([pieces[i] for i in short]), strict=True):
            out[i] = ids
        for i, p in enumerate(pieces):
            if out[i] is None:
                out[i] = self._windowed(p)
        return np.concatenate(out).astype(np.int32), np.array([len(x) for x in out])

    def learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        ids, counts = self.merged(pieces)
        sizes = np.array([len(p) for p in pieces])
        spots = [len(self.ids) + np.cumsum(counts) - counts, counts, len(self.held) + np.cumsum(sizes) - sizes, sizes]
        every = np.concatenate([self.hashes, hashes])
        order = np.argsort(every)
        self.hashes = every[order]
        self.spots = np.concatenate([self.spots, spots], axis=1)[:, order]
        self.ids = np.concatenate([self.ids, ids])
        self.held = np.concatenate([self.held, np.frombuffer(b"".join(pieces), np.uint8)])

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        buf, off = T.text_bytes(column)
        # Code points begin at the bytes that do not continue one.
        heads = (buf & 0xC0) != 0x80
        before = np.concatenate([[0], np.cumsum(heads)])
        points = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        begin = np.flatnonzero(heads)[piece_starts(points, before[off])]
        end = np.append(begin[1:], len(buf))
        if len(begin) == 0:
            return np.zeros(0, np.int32), np.zeros(len(off) - 1, np.int64)
        found = self._found(buf, begin, end)
        while found is None:  # two pieces had one hash
            self.seed += 1
            self.forget()
            found = self._found(buf, begin, end)
        place, length = found
        total = np.cumsum(length)
        ids = self.ids[np.arange(int(total[-1])) - np.repeat(total - length - place, length)]
        piece_text = np.searchsorted(off, begin, side="right") - 1
        counts = np.bincount(piece_text, weights=length, minlength=len(off) - 1)
        return ids, counts.astype(np.int64)

    def _found(self, buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """(where the ids of every piece begin, how many), learning pieces not met; none if
        a piece has not the bytes that its hash stands for."""
        hashes = T.word_hashes(buf, begin, end, self.seed)
        distinct, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        new = ~np.isin(distinct, self.hashes, assume_unique=True)
        if new.any():
            grown = len(self.held) + int((end - begin)[index[new]].sum())
            if len(self.hashes) + int(new.sum()) > KEPT_PIECES or grown > KEPT_BYTES:
                self.forget()
                new[:] = True
            raw = buf.tobytes()
            self.learn(distinct[new], [raw[begin[i] : end[i]] for i in index[new]])
        place, length, start, size = self.spots[:, np.searchsorted(self.hashes, distinct)][:, inverse]
        if not np.array_equal(size, end - begin):
            return None
        if not np.array_equal(self.held[np.repeat(start - begin, size) + np.arange(len(buf))], buf):
            return None
        return place, length

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of every text."""
        out = [b""] * len(counts)
        text = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        con = self.vocabulary.connection
        ends = np.cumsum(counts)
        at, base = 0, 0
        while at < len(counts):
            to = max(at + 1, int(np.searchsorted(ends, base + IDS, side="right")))
            last = int(ends[to - 1])
            rows = pa.table(
                {
                    "text": text[base:last],
                    "place": np.arange(last - base, dtype=np.int32),
                    "id": ids[base:last],
                }
            )
            con.register("ids", rows)
            found = con.sql(DECODE).to_arrow_table()
            con.unregister("ids")
            for t, b in zip(found.column("text").to_pylist(), found.column("bytes").to_pylist(), strict=True):
                out[t] = b.encode("latin-1")
            at, base = to, last
        return out


def _merged_spans(spans: list[tuple[int, int]], apart: set[int]) -> list[tuple[int, int]]:
    """Windows that nowhere meet the next become one with it."""
    out, i = [], 0
    while i < len(spans):
        if i in apart:
            out.append((spans[i][0], spans[i + 1][1]))
            i += 2
        else:
            out.append(spans[i])
            i += 1
    return out


_encoders: dict[int, Encoder] = {}
keeps("bpe", _encoders.clear)


def _encoder(vocabulary: Vocabulary) -> Encoder:
    """One encoder per worker process and vocabulary: what it knows helps later tasks."""
    key = hash(vocabulary.tokens)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocabulary)
    return _encoders[key]


def encode_ids(column, vocabulary: Vocabulary) -> list[np.ndarray]:
    """The ids of every text of an Arrow column."""
    ids, counts = _encoder(vocabulary).encode(column)
    return np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else []


def _shared(docs: DataFrame, vocabulary: Vocabulary):
    """The vocabulary as a broadcast: tens of thousands of short tokens, however many rows."""
    return docs.sparkSession.sparkContext.broadcast(vocabulary)


def with_ids(docs: DataFrame, vocabulary: Vocabulary, name: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text`` (null: none) as an array column; no shuffle.  A
    column of that name is replaced."""
    shared = _shared(docs, vocabulary)

    @F.arrow_udf("array<int>")
    def encode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            out = [
                pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids)
                )
                for ids, counts in (
                    _encoder(shared.value).encode(s.column(0))
                    for s in T.sliced(pa.table({"text": part}))
                )
            ]
            yield pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int32()))

    return docs.withColumn(name, encode("text"))


def decoded(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``df`` with the bytes that an array column of ids stands for (null: none); no shuffle."""
    shared = _shared(df, vocabulary)

    @F.arrow_udf("binary")
    def decode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            counts = np.array([len(x) if x.is_valid else 0 for x in part], dtype=np.int64)
            flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
            yield pa.array(_encoder(shared.value).decode(flat, counts), pa.binary())

    return df.withColumn(name, decode(ids))


#: Bytes of a text that is worked through in parts; changes no result.
LONG_TEXT = 2 * T.SLICE_BYTES


def _long_report(encoder: Encoder, text: str) -> tuple[int, str, str]:
    """The report on one long text, part by part."""
    n, ids_digest, text_digest = 0, hashlib.sha256(), hashlib.sha256()
    for part in T.text_parts(text):
        ids, counts = encoder.encode(pa.array([part]))
        n += len(ids)
        ids_digest.update(ids.astype("<u4").tobytes())
        text_digest.update(encoder.decode(ids, counts)[0])
    return n, ids_digest.hexdigest(), text_digest.hexdigest()


REPORT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def bpe_report(docs: DataFrame, vocabulary: Vocabulary, place: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): number of ids, digest of the ids as
    little-endian 32-bit integers, digest of the decoded bytes, and the column ``place`` of
    whole numbers if one is named.

    A null text is empty and has no ids.  Rows are independent of each other; repeated rows
    give repeated results and an empty table an empty one.
    """
    shared = _shared(docs, vocabulary)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.sliced(batch):
                encoder = _encoder(shared.value)
                if part.column("text").nbytes > LONG_TEXT and part.num_rows == 1:
                    found = _long_report(encoder, part.column("text")[0].as_py())
                    columns = [pa.array([x]) for x in found]
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns, *[part.column(c) for c in more]], names=names)
                    continue
                ids, counts = encoder.encode(part.column("text"))
                texts = encoder.decode(ids, counts)
                raw = ids.astype("<u4").tobytes()
                ends = 4 * np.cumsum(counts)
                digests = [
                    hashlib.sha256(raw[b - 4 * n : b]).hexdigest()
                    for b, n in zip(ends.tolist(), counts.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(counts),
                        pa.array(digests, pa.string()),
                        pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                        *[part.column(c) for c in more],
                    ],
                    names=names,
                )

    more = [place] if place else []
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *more]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[F.col(c).cast("long").alias(c) for c in more])
    return rows.mapInArrow(report, ", ".join([REPORT, *[f"`{c}` long" for c in more]]))
