"""Near-duplicate vectors by a subspace pigeonhole join.

For unit vectors a cosine of at least c is a squared distance of at most 2 - 2c.  Vectors
are turned by a random rotation, which spreads any direction over all coordinates, and cut
into blocks of eight.  If a pair keeps within its whole budget, it keeps within a block's
part of it, proportional to the block's width, in one block at least.  So each block is
range-joined under its part, and the union of what the blocks find is verified by the exact
cosine in double precision.

Distinct vectors are written once, in tiles, and every pair of tiles is a task's that reads both
from there: no vector is sent to where it is compared, so that files and exchanges grow as the
table does, though the pairs grow with its square.  Inside a task, a block's range join halves
the vectors of one tile along their longest sides into small boxes, and only those of the other
within range of a box are compared with what is in it; a pair that several blocks find counts
in the first of them.  Only sums of links and a spanning forest of a task's links leave it, never
the pairs.  Equal vectors are one class with a number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shared import cut

WIDTH = 8
#: Vectors of a tile at most, those of one that are compared with the boxes of another at a time,
#: and vectors of a box.
TILE, CELL_ROWS, LEAF = 32_768, 32_768, 256
#: Entries of a task's sums and links that are held before they are summed up.
HELD = 1 << 20
_SLACK = 1e-5
_rotations: dict[int, np.ndarray] = {}


def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation."""
    if dim not in _rotations:
        q, r = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))
        _rotations[dim] = q * np.sign(np.diag(r))
    return _rotations[dim]


def subspaces(dim: int) -> list[slice]:
    n = -(-dim // WIDTH)
    edges = [i * dim // n for i in range(n + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]


def turned(vectors: np.ndarray) -> np.ndarray:
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return (unit @ rotation(vectors.shape[1])).astype(np.float32)


_TILES = "no long, dim int, reps binary, numbers binary, vectors binary"


def _in_tiles(most: int):
    """The classes of a task in tiles of up to ``most`` vectors of one size, numbered apart."""

    def in_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, size = TaskContext.get().partitionId(), 0, 0
        held: dict[int, list[tuple[np.ndarray, np.ndarray, bytes]]] = {}

        def tiles() -> Iterator[pa.RecordBatch]:
            nonlocal made
            for dim, some in held.items():
                columns = [
                    pa.array([made << 32 | part], pa.int64()),
                    pa.array([dim], pa.int32()),
                    *(pa.array([np.concatenate([x[i] for x in some]).tobytes()], pa.binary()) for i in (0, 1)),
                    pa.array([b"".join(x[2] for x in some)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["no", "dim", "reps", "numbers", "vectors"])
                made += 1
            held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, most):
                some = batch.slice(at, most)
                if size + some.num_rows > most:
                    yield from tiles()
                    size = 0
                size += some.num_rows
                raw = some.column("vector").to_pylist()
                dims = np.array([len(x) // 4 for x in raw])
                for dim in np.unique(dims).tolist():
                    own = np.flatnonzero(dims == dim)
                    ids, numbers = (some.column(c).to_numpy()[own] for c in ("rep", "number"))
                    held.setdefault(dim, []).append((ids, numbers, b"".join([raw[i] for i in own])))
        yield from tiles()

    return in_tiles


def _from_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The classes of tiles, with a digest for the vector."""
    for batch in batches:
        for dim, reps, numbers, vectors in zip(*(batch.column(c).to_pylist() for c in ("dim", "reps", "numbers", "vectors")), strict=True):
            digests = [hashlib.sha256(vectors[i : i + 4 * dim]).digest() for i in range(0, len(vectors), 4 * dim)]
            columns = [pa.array(np.frombuffer(reps, np.int64)), pa.array(np.frombuffer(numbers, np.int64)), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["rep", "number", "digest"])


class _Side:
    """The vectors of tiles: ids, numbers, unit vectors, turned vectors."""

    def __init__(self, ids, numbers, unit, points) -> None:
        self.ids, self.numbers, self.unit, self.points = ids, numbers, unit, points

    @classmethod
    def of(cls, dim: int, tiles: list[tuple]) -> _Side:
        ids, numbers = (np.frombuffer(b"".join([t[i] for t in tiles]), np.int64) for i in (0, 1))
        vectors = np.frombuffer(b"".join([t[2] for t in tiles]), np.float32).reshape(-1, dim).astype(np.float64)
        return cls(ids, numbers, vectors / np.linalg.norm(vectors, axis=1, keepdims=True), turned(vectors))


def _near(a: np.ndarray, b: np.ndarray, budget: float) -> np.ndarray:
    """Which pairs are within a squared distance, by one product: |a|^2 + |b|^2 - 2ab."""
    one = lambda x: np.ones((len(x), 1), x.dtype)
    square = lambda x: (x * x).sum(axis=1, keepdims=True)
    distance = np.hstack([a, square(a), one(a)]) @ np.hstack([-2 * b, one(b), square(b)]).T
    return distance <= budget * (1 + _SLACK) + _SLACK


def _boxes(points: np.ndarray, homes: np.ndarray, guests: np.ndarray, limit: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(homes, guests) that are left to compare: homes are halved along their longest side,
    and a guest goes on with a half only if it is near enough to the half's box."""
    todo = [(homes, guests)]
    while todo:
        homes, guests = todo.pop()
        inside, outside = points[homes], points[guests]
        low, high = inside.min(axis=0), inside.max(axis=0)
        away = np.maximum(np.maximum(low - outside, outside - high), 0)
        guests = guests[(away * away).sum(axis=1) <= limit]
        if len(guests) == 0:
            continue
        if len(homes) <= LEAF:
            yield homes, guests
            continue
        half = len(homes) // 2
        order = np.argpartition(inside[:, np.argmax(high - low)], half)
        todo += [(homes[order[:half]], guests), (homes[order[half:]], guests)]


def _verified(every: _Side, homes: np.ndarray, guests: np.ndarray, block: int, budget: float, least: float):
    """(home, guest) of the pairs that this block is the first to find and whose cosine is
    high enough."""
    dim = every.points.shape[1]
    parts = subspaces(dim)
    part = lambda i: budget * (parts[i].stop - parts[i].start) / dim
    near = np.flatnonzero(_near(every.points[homes, parts[block]], every.points[guests, parts[block]], part(block)))
    x, y = homes[near // len(guests)], guests[near % len(guests)]
    other = every.ids[x] != every.ids[y]
    x, y = x[other], y[other]
    fresh = np.ones(len(x), bool)
    for i in range(block):
        d = every.points[x, parts[i]] - every.points[y, parts[i]]
        fresh &= ~((d * d).sum(axis=1) <= part(i) * (1 + _SLACK) + _SLACK)
    x, y = x[fresh], y[fresh]
    hit = np.zeros(len(x), bool)
    for i in range(0, len(x), 1 << 18):
        s = slice(i, i + (1 << 18))
        hit[s] = np.einsum("ij,ij->i", every.unit[x[s]], every.unit[y[s]]) >= least
    return x[hit], y[hit]


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of every id with the smallest that the given links lead to."""
    ids, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    label = np.arange(len(ids))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    below = label < np.arange(len(ids))
    return ids[below], ids[label[below]]


class _Found:
    """Links of some vectors: their sums by id, and a spanning forest."""

    def __init__(self) -> None:
        self.sums: list[tuple[np.ndarray, np.ndarray]] = []
        self.forest: list[tuple[np.ndarray, np.ndarray]] = []
        self._held = 0

    def add(self, every: _Side, count: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
        linked = np.flatnonzero(count)
        self.sums.append((every.ids[linked], count[linked]))
        self.forest.append(_forest(u, v))
        self._held += len(linked) + len(self.forest[-1][0])
        if self._held > HELD:
            self.sum_up()

    def sum_up(self) -> None:
        if self.sums:
            ids, counts = (np.concatenate(x) for x in zip(*self.sums, strict=True))
            distinct, place = np.unique(ids, return_inverse=True)
            total = np.zeros(len(distinct), np.int64)
            np.add.at(total, place, counts)
            self.sums = [(distinct, total)]
            self.forest = [_forest(*(np.concatenate(x) for x in zip(*self.forest, strict=True)))]
            # What is left may be as much; it is summed up again when as much again has come.
            self._held = 0


def _linked(every: _Side, homes: np.ndarray, guests: np.ndarray, both: bool, budget: float, least: float, found: _Found) -> None:
    """Adds the links of ``homes`` with ``guests``, for the guests only if ``both``: those of one
    tile meet in either order."""
    dim = every.points.shape[1]
    for block, own in enumerate(subspaces(dim)):
        mine = np.ascontiguousarray(every.points[:, own])
        limit = budget * mine.shape[1] / dim * (1 + _SLACK) + _SLACK
        count, u, v = np.zeros(len(every.ids), np.int64), [], []
        for at in range(0, len(guests), CELL_ROWS):
            for some, near in _boxes(mine, homes, guests[at : at + CELL_ROWS], limit):
                x, y = _verified(every, some, near, block, budget, least)
                if len(x):
                    np.add.at(count, x, every.numbers[y])
                    if both:
                        np.add.at(count, y, every.numbers[x])
                    a, b = _forest(every.ids[x], every.ids[y])
                    u.append(a)
                    v.append(b)
        if u:
            found.add(every, count, np.concatenate(u), np.concatenate(v))


def _links(budget: float, least: float):
    """The sums and the forest of all pairs of tiles of a task."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Found()
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                tiles = [tuple(row[c] for c in ("reps", "numbers", "vectors"))]
                if row["no"] != row["other_no"]:
                    tiles.append(tuple(row[f"other_{c}"] for c in ("reps", "numbers", "vectors")))
                every = _Side.of(row["dim"], tiles)
                n = len(tiles[0][0]) // 8
                first = np.arange(n)
                second = np.arange(n, len(every.ids)) if len(tiles) > 1 else first
                _linked(every, first, second, len(tiles) > 1, budget, least, found)
        found.sum_up()
        for (ids, counts), (a, b) in zip(found.sums, found.forest, strict=True):
            columns = [
                pa.array(np.concatenate([ids, a])),
                pa.array(np.concatenate([np.full(len(ids), -1), b])),
                pa.array(np.concatenate([counts, np.zeros(len(a), np.int64)])),
                pa.array(np.arange(len(ids) + len(a)) >= len(ids)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["u", "v", "links", "forest"])

    return links


def _pairs(tiles: DataFrame) -> DataFrame:
    """Every two tiles of vectors of one size once, and each with itself, in as many tasks as two
    scans of the tiles have together: each reads its tiles anew, and nothing is exchanged."""
    other = tiles.select([F.col(c).alias(f"other_{c}") for c in tiles.columns]).hint("shuffle_replicate_nl")
    no, with_no = F.col("no"), F.col("other_no")
    # The lower number comes first only if the sum is even, so that work is spread over all tasks.
    once = (no == with_no) | (no != with_no) & ((no < with_no) == ((no + with_no) % 2 == 0))
    return tiles.join(other, once & (F.col("dim") == F.col("other_dim")))


def _usable(vector: str):
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return finite & F.exists(vector, lambda x: x != 0)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [np.asarray(x.values, np.float32).tobytes() for x in batch.column("embedding")]
        columns = [batch.column("vec_id"), pa.array(raw, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "vector"])


def linked_vectors(embeddings: DataFrame, cosine: float = 0.9) -> DataFrame:
    """One row per row of ``embeddings`` (vec_id, embedding): n_links, component_id, kept.

    Two vectors are linked if they have as many components and their cosine is at least
    ``cosine``.  ``component_id`` is the smallest vec_id that links reach, and that vector
    is ``kept``.  Vectors that are null, empty, zero, or hold a null or non-finite component
    have no links.  A row with a null vec_id has no links, a null component, and is kept.
    Equal vectors under several ids, or repeated rows, are linked with each other.  Labels
    and other columns are not looked at.  An empty table gives an empty one.
    """
    given = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding")
    )
    usable = F.coalesce(_usable("embedding"), F.lit(False)) & F.col("vec_id").isNotNull()
    vectors = given.where(usable).mapInArrow(_packed, "vec_id long, vector binary")
    grouped = vectors.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("number"))
    tiles = cut(grouped.mapInArrow(_in_tiles(TILE), _TILES), "vectors")
    found = _pairs(tiles).mapInArrow(_links(2 - 2 * cosine, cosine), "u long, v long, links long, forest boolean")
    found = cut(found, "found")
    sums = found.where("not forest").groupBy("u").agg(F.sum("links").alias("links"))
    groups = components(found.where("forest").select("u", "v"))
    # A digest stands for a vector from here on: it is an eighth of 64 components.
    classes = tiles.mapInArrow(_from_tiles, "rep long, number long, digest binary")
    per_class = (
        classes.join(sums, classes["rep"] == sums["u"], "left")
        .join(groups, F.col("rep") == F.col("node"), "left")
        .select(
            "digest",
            (F.coalesce("links", F.lit(0)) + F.col("number") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    digests = vectors.select("vec_id", F.unhex(F.sha2("vector", 256)).alias("digest"))
    linked = digests.join(per_class, "digest").select("vec_id", "n_links", "component")
    alone = given.where(~usable).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component")
    )
    return linked.unionByName(alone).select(
        "vec_id",
        "n_links",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("component"), F.lit(True)).alias("kept"),
    )
