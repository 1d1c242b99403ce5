import numpy as np
import pytest

from tests.llm.test_components import brute as union
from tidemark.llm import embeddings
from tidemark.llm.embeddings import linked_vectors


def brute(rows, least):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            good[i] = x / np.linalg.norm(x)
    links, count = [], dict.fromkeys([i for i, _ in rows if i is not None], 0)
    ids = sorted(good)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if len(good[a]) == len(good[b]) and good[a] @ good[b] >= least:
                links.append((a, b))
                count[a] += 1
                count[b] += 1
    root = union(links)
    return {(i, n, root.get(i, i), root.get(i, i) == i) for i, n in count.items()}


def vectors(dim=64):
    rng = np.random.default_rng(3)
    out = [rng.normal(size=dim) for _ in range(150)]
    for spread in (0.02, 0.05, 0.06, 0.3):
        base = rng.normal(size=dim)
        base /= np.linalg.norm(base)
        out += [base + rng.normal(size=dim) * spread for _ in range(60)]
    out += [out[0], out[0] * 2, -out[0]]
    return [(int(i), [float(np.float32(x)) for x in v]) for i, v in zip(rng.permutation(len(out)), out, strict=True)]


@pytest.fixture
def frame(rows):
    return lambda data: rows("vec_id long, embedding array<float>, label int, rep int", [(i, v, 1, 2) for i, v in data])


def test_same_as_brute_force(frame, monkeypatch):
    odd = [(9000, None), (9001, []), (9002, [0.0] * 64), (9003, [1.0, None] * 32), (9004, [float("nan")] * 64), (9005, [float("inf")] * 64), (9006, [1.0, 2.0]), (9007, [2.0, 4.0]), (9008, [1.0])]
    data = vectors() + odd
    got = set(map(tuple, linked_vectors(frame(data)).collect()))
    assert got == brute(data, 0.9)
    monkeypatch.setattr(embeddings, "TILE", 16)
    monkeypatch.setattr(embeddings, "CELL_ROWS", 40)
    monkeypatch.setattr(embeddings, "LEAF", 7)
    assert set(map(tuple, linked_vectors(frame(data)).collect())) == got
    assert set(map(tuple, linked_vectors(frame(data), cosine=0.75).collect())) == brute(data, 0.75)


def test_null_ids_copies_and_empty_table(frame):
    data = [(None, [1.0, 0.0]), (5, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [1.0, 0.1])]
    out = sorted(map(tuple, linked_vectors(frame(data)).collect()), key=str)
    assert out == sorted([(None, 0, None, True), (5, 2, 3, False), (3, 2, 3, True), (4, 2, 3, False)], key=str)
    assert linked_vectors(frame([])).collect() == []


def test_vectors_are_not_sent_to_where_they_are_compared(frame, spark, monkeypatch):
    """What is written of links is worked out without an exchange, and holds an id once a task."""
    plans, kept, cut = {}, {}, embeddings.cut

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        kept[name] = cut(df, name)
        return kept[name]

    monkeypatch.setattr(embeddings, "cut", noted)
    monkeypatch.setattr(embeddings, "TILE", 8)
    data = vectors() + [(5000 + i, [1.0, float(i)]) for i in range(20)]
    assert set(map(tuple, linked_vectors(frame(data)).collect())) == brute(data, 0.9)
    assert "Exchange" not in plans["found"] and "CartesianProduct" in plans["found"]
    tiles = [(r.no, r.dim, len(r.reps) // 8) for r in kept["vectors"].collect()]
    assert len({no for no, _, _ in tiles}) == len(tiles) and max(n for *_, n in tiles) <= 8
    assert sum(n for *_, n in tiles) == len({tuple(v) for _, v in data})
    pairs = [frozenset(r) for r in embeddings._pairs(kept["vectors"]).select("no", "other_no").collect()]
    want = {frozenset((a, b)) for a, m, _ in tiles for b, n, _ in tiles if m == n}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_sums_and_forest_are_held_in_bounds(monkeypatch):
    data = {i: v for i, v in vectors()}
    ids = np.array(sorted(data), np.int64)
    raw = np.array([data[i] for i in ids.tolist()], np.float32)
    side = embeddings._Side.of(64, [(ids.tobytes(), np.ones(len(ids), np.int64).tobytes(), raw.tobytes())])
    half = np.arange(200), np.arange(200, len(ids))
    got = []
    for held, rows, leaf in ((1 << 20, 1 << 15, 256), (5, 10, 7)):
        monkeypatch.setattr(embeddings, "HELD", held)
        monkeypatch.setattr(embeddings, "CELL_ROWS", rows)
        monkeypatch.setattr(embeddings, "LEAF", leaf)
        found = embeddings._Found()
        embeddings._linked(side, *half, True, 0.2, 0.9, found)
        found.sum_up()
        ((u, n),), ((a, b),) = found.sums, found.forest
        got.append((dict(zip(u.tolist(), n.tolist(), strict=True)), union(list(zip(a.tolist(), b.tolist(), strict=True)))))
    unit = side.unit[half[0]] @ side.unit[half[1]].T >= 0.9
    want = dict(zip(ids.tolist(), np.concatenate([unit.sum(axis=1), unit.sum(axis=0)]).tolist(), strict=True))
    assert got[0] == got[1] and got[0][0] == {i: n for i, n in want.items() if n}


def test_an_id_of_several_vectors(frame):
    """Its rows share the sums of links with others, and are not linked with each other."""
    data = [(1, [1.0, 0.0]), (1, [1.0, 0.05]), (2, [1.0, 0.01]), (3, [0.0, 1.0])]
    out = sorted(map(tuple, linked_vectors(frame(data)).collect()))
    assert out == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]
