"""Near-duplicate documents by MinHash, banding, verification and connected components.

Every document's set of word shingles gets the minima of many universal hash functions.
Documents whose minima agree in a whole band are candidates.  Candidates of a band are
compared by all their minima; what may reach the threshold, with a margin of five standard
deviations, makes candidate groups.  Inside a group, links are confirmed on the full sets,
and confirmed links make the final components.

Documents of equal sets are one class with its smallest doc_id as representative, so that a
group of copies costs what one document costs.  Bands and candidate groups of any size are
compared in pairs of bounded tiles; a member is only compared with those not yet linked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textops as T
from tidemark.llm.components import components
from tidemark.llm.groups import by_group, linked_stars, stars, tiled
from tidemark.llm.shared import cut

SHINGLE = 5
#: A pair of similarity 0.85 shares no band with probability 3e-7, one of 0.8 with 6e-5.
BANDS, ROWS = 32, 6
HASHES = BANDS * ROWS
BAND_TILE, SET_TILE = 512, 256
_RNG = np.random.default_rng(5)
_A = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64)
_LINKS = "u long, v long"


def shingle_sets(column, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the distinct shingles of all texts, ascending in each; set sizes).  A
    text with fewer words than a shingle has one: all its words."""
    buf, off = T.text_bytes(column)
    buf = T.lower(buf)
    begin, end, counts = T.word_bounds(buf, off)
    words = T.word_hashes(buf, begin, end)
    firsts = np.cumsum(counts) - counts
    starts = T.window_starts(counts, shingle)
    hashes = T.window_hashes(words, starts, shingle)
    owner = np.repeat(np.arange(len(counts)), np.maximum(counts - shingle + 1, 0))
    for k in range(1, shingle):
        short = np.flatnonzero(counts == k)
        if len(short):
            hashes = np.concatenate([hashes, T.window_hashes(words, firsts[short], k)])
            owner = np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.bincount(owner[new], minlength=len(counts))


def _features(shingle: int):
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.sliced(batch):
                sets, sizes = shingle_sets(part.column("text"), shingle)
                yield _signed(part.column("doc_id"), sets, sizes)

    return features


def _signed(ids, sets: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(sizes)
    n = len(sizes)
    high, low = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    signature = np.zeros((n, HASHES), np.uint8)
    bands = np.zeros((n, BANDS), np.uint64)
    if len(some):
        starts = (np.cumsum(sizes) - sizes)[some]
        with np.errstate(over="ignore"):
            # A set's name: sums of two scramblings of its members.
            high[some] = np.add.reduceat(T.mix(sets), starts)
            low[some] = np.add.reduceat(T.mix(sets ^ np.uint64(0x5DEECE66D1234567)), starts)
            for i in range(HASHES):
                least = T.mix(np.minimum.reduceat(sets * _A[i] + _B[i], starts))
                signature[some, i] = least >> np.uint64(56)
                band = i // ROWS
                bands[some, band] = T.mix(bands[some, band] * np.uint64(31) + least + np.uint64(band))
    filled = sizes > 0
    offsets = np.concatenate([[0], np.cumsum(np.where(filled, BANDS, 0))])
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(sizes.astype(np.int64)),
            pa.array(high.view(np.int64)),
            pa.array(low.view(np.int64)),
            pa.array([s.tobytes() for s in signature], pa.binary()),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(bands[filled].reshape(-1).view(np.int64))),
        ],
        names=["doc_id", "n_shingles", "high", "low", "signature", "bands"],
    )


def _band_links(percent: int):
    t = percent / 100
    least = math.floor(HASHES * (t - 5 * math.sqrt(t * (1 - t) / HASHES)))

    def links(table: pa.Table) -> pa.Table | None:
        ids = table.column("rep").to_numpy()
        raw = b"".join(table.column("signature").to_pylist())
        minima = np.frombuffer(raw, np.uint8).reshape(-1, HASHES)

        def linked(i: int, others: np.ndarray) -> np.ndarray:
            return (minima[others] == minima[i]).sum(axis=1) >= least

        return stars(ids, linked_stars(len(ids), linked))

    return links


def _set_links(percent: int):
    def links(table: pa.Table) -> pa.Table | None:
        ids = table.column("rep").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
        sizes = np.array([len(s) for s in sets])
        _, members = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        has = np.zeros(int(members.max()) + 1, dtype=np.int64)

        def linked(i: int, others: np.ndarray) -> np.ndarray:
            own = members[starts[i] : ends[i]]
            hit = np.zeros(len(others), dtype=bool)
            n = sizes[others]
            able = np.flatnonzero(100 * np.minimum(n, len(own)) >= percent * np.maximum(n, len(own)))
            if len(able) == 0:
                return hit
            has[own] = 1
            some = others[able]
            spot = np.arange(int(sizes[some].sum())) + np.repeat(starts[some] - np.cumsum(sizes[some]) + sizes[some], sizes[some])
            firsts = np.cumsum(sizes[some]) - sizes[some]
            common = np.add.reduceat(has[members[spot]], firsts)
            has[own] = 0
            hit[able] = 100 * common >= percent * (len(own) + sizes[some] - common)
            return hit

        return stars(ids, linked_stars(len(ids), linked))

    return links


def _with_sets(shingle: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.sliced(batch):
                hashes, sizes = shingle_sets(part.column("text"), shingle)
                raw = np.split(hashes, np.cumsum(sizes)[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("rep"),
                        part.column("group"),
                        part.column("size"),
                        pa.array([x.tobytes() for x in raw], pa.binary()),
                    ],
                    names=["rep", "group", "size", "shingles"],
                )

    return sets


def near_duplicates(docs: DataFrame, percent: int = 80, shingle: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_shingles, component_id, kept.

    Words are lower-cased (A-Z).  Two documents are linked if 100 times the shingles they
    share are at least ``percent`` times those that either has.  ``component_id`` is the
    smallest doc_id that links reach; that document is ``kept``.  Documents without words,
    and null texts, have no shingles and no links.  Rows that share a doc_id are one
    document.  A row with a null doc_id has a null component and is kept.  Other columns
    are not looked at.  An empty table gives an empty one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n_shingles long, high long, low long, signature binary, bands array<long>"
    signed = cut(docs.mapInArrow(_features(shingle), schema), "minhash")
    named = signed.where("doc_id is not null and n_shingles > 0")
    first = F.min(F.struct(F.col("doc_id").alias("rep"), "signature", "bands")).alias("first")
    classes = named.groupBy("high", "low", "n_shingles").agg(first)
    classes = cut(classes.select("high", "low", "n_shingles", "first.*"), "classes")
    reps = classes.select("rep", "signature", "bands")
    banded = reps.select("rep", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = banded.join(shared, "band").join(reps.select("rep", "signature"), "rep")
    met = tiled(met, "band", "rep", F.col("size"), BAND_TILE).select("band", "tile_a", "tile_b", "rep", "signature")
    likely = components(by_group(met, ["band", "tile_a", "tile_b"], _band_links(percent), _LINKS))
    likely = cut(likely.select(F.col("node").alias("rep"), F.col("component").alias("group")), "likely")
    size = likely.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
    wanted = likely.join(size, "group")
    # Candidates grow with the corpus: the join is a merge of both sides at every size.
    wanted = wanted.hint("merge")
    texts = docs.join(wanted, docs["doc_id"] == wanted["rep"]).select("rep", "group", "size", "text")
    held = texts.mapInArrow(_with_sets(shingle), "rep long, group long, size long, shingles binary")
    held = tiled(held, "group", "rep", F.col("size"), SET_TILE).select("group", "tile_a", "tile_b", "rep", "shingles")
    final = components(by_group(held, ["group", "tile_a", "tile_b"], _set_links(percent), _LINKS))
    by_class = classes.join(final, classes["rep"] == final["node"], "left").select(
        "high", "low", "n_shingles", F.coalesce("component", "rep").alias("component")
    )
    found = signed.select("doc_id", "n_shingles", "high", "low").join(
        by_class, ["high", "low", "n_shingles"], "left"
    )
    own = F.when((F.col("n_shingles") == 0) | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return found.select(
        "doc_id",
        "n_shingles",
        own.alias("component_id"),
        F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, percent: int = 80, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one document of each group of near duplicates; all columns stay.  Of
    rows that share a doc_id one stays; rows with a null doc_id all stay."""
    found = cut(near_duplicates(docs, percent, shingle), "near")
    gone = found.where("not kept").select("doc_id").distinct()
    stay = docs.join(gone, "doc_id", "left_anti")
    repeated = cut(
        found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated"
    )
    if repeated.isEmpty():
        return stay.select(*docs.columns)
    once = stay.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return stay.join(repeated, "doc_id", "left_anti").unionByName(once).select(*docs.columns)
