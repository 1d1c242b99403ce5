import zlib
from collections import Counter

import numpy as np

from tidemark.llm.sharding import jump, shard_report, with_shard


def one_by_one(key, shards):
    b, j, key = -1, 0, key % 2**64
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_same_as_the_loop():
    keys = np.array([0, 1, 2, 2**63, 2**64 - 1, *range(10, 3000, 7)], dtype=np.uint64)
    for shards in (1, 2, 16, 17, 1000):
        assert jump(keys, shards).tolist() == [one_by_one(int(k), shards) for k in keys]


def test_one_more_shard_takes_only_into_itself():
    keys = np.arange(20000, dtype=np.uint64)
    a, b = jump(keys, 16), jump(keys, 17)
    assert set(b[a != b]) == {16} and abs((a != b).mean() - 1 / 17) < 0.01
    assert max(np.bincount(a)) < 1.1 * 20000 / 16


def test_report(docs):
    rows = [(i, f"t{i % 50}é") for i in range(500)] + [(7, "x")] * 300 + [(None, None), (None, ""), (-3, "neg")]
    frame = docs(rows).selectExpr("*", "1 as shard", "2 as _n", "3 as _block", "4 as slot")
    out = shard_report(frame).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    for r in out:
        assert r.shard == one_by_one(r.doc_id or 0, 16) and r.grown_shard == one_by_one(r.doc_id or 0, 17)
        assert r.law == "key"
    for s in range(16):
        mine = sorted((r.slot, r.doc_id is not None, r.doc_id or 0) for r in out if r.shard == s)
        assert [m[0] for m in mine] == list(range(len(mine)))
        assert [m[1:] for m in mine] == sorted(m[1:] for m in mine)
    assert shard_report(docs([])).collect() == []


def test_other_columns_stay(docs):
    frame = docs([(1, "a"), (2, None)])
    assert with_shard(frame, "doc_id", 8).drop("shard").collect() == frame.collect()
