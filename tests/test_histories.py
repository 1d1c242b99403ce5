"""Validity intervals, closures, persistent keys and table differences, by hand."""

import random
import zlib
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import final_plan_of, plan_of
from tidemark.operators import hierarchy as h
from tidemark.operators import validity as v
from tidemark.sinks import keymap
from tidemark.sources import table_diff as t

DAY0 = date(2024, 1, 1)
END = 200


def day(n):
    return None if n is None else DAY0 + timedelta(days=n)


def random_versions(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(120):
        a = rng.choice([None, *[rng.randrange(90)] * 8])
        b = rng.choice([None, (a or 0) + rng.choice([-2, 0, 1, 5, 30])] + [(a or 0) + rng.randrange(1, 12)] * 6)
        out.append((rng.choice("ab") if rng.random() < 0.9 else None, rng.choice([1, 2, None]), day(a), day(b)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_versions(spark, seed):
    rows = random_versions(seed)
    covered, kinds = {}, Counter()
    for key, value, a, b in rows:
        if a is not None and (b is None or b > a):
            covered.setdefault((key, value), set()).update(range((a - DAY0).days, END if b is None else (b - DAY0).days))
    expected = []
    for (key, value), days in covered.items():
        for n in sorted(days):
            if n - 1 not in days:
                end = n
                while end in days:
                    end += 1
                expected.append((key, value, day(n), None if end == END else day(end)))
                kinds[key] += 1
    df = spark.createDataFrame(rows + rows[:20], "k string, x int, a date, b date")
    got = [tuple(r) for r in v.merged_versions(df, "k", "a", "b", ["x"]).collect()]
    assert sorted(map(str, got)) == sorted(map(str, expected)) and len(expected) > 10


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_valid(spark, how):
    rng = random.Random(4)
    versions = [(k, x or 0, a, b) for k, x, a, b in random_versions(3)]
    rows = [(i, rng.choice(["a", "b", None, "z"]), day(rng.choice([None, *range(0, 120, 3)]))) for i in range(100)]
    expected = []
    for i, key, at in rows:
        hits = [x for k, x, a, b in versions if k == key and at and a and a <= at and (b is None or at < b)]
        expected += [(i, key, at, x) for x in hits] or ([(i, key, at, None)] if how == "left" else [])
    df = spark.createDataFrame(rows, "i int, k string, at date")
    other = spark.createDataFrame(versions, "k string, x int, a date, b date")
    out = v.join_valid(df, other, "k", "at", "a", "b", ["x"], how, bucket_days=7)
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, expected))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "NestedLoop" not in plan_of(out) and "Cartesian" not in plan_of(out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert v.join_valid(df.limit(0), other, "k", "at", "a", "b", ["x"], how).count() == 0


def test_ancestor_closure(spark, tmp_path):
    rng = random.Random(9)
    parent = {i: rng.randrange(i) if i > 2 and rng.random() < 0.97 else None for i in range(300)}
    parent |= {i: i - 1 for i in range(1001, 1070)} | {1000: None}  # a long chain
    parent |= {500: 501, 501: 502, 502: 500, 503: 502, 504: 503, 600: 600, 601: 600, 700: 9999, 701: 700}
    ancestors, standing = [], {}
    for unit in parent:
        seen, up = [], parent[unit]
        while up in parent and up is not None and len(seen) < 2000:
            seen.append(up)
            up = parent[up]
        circular = len(seen) == 2000
        if not circular:
            ancestors += [(unit, a, n + 1) for n, a in enumerate(seen)]
        standing[unit] = "cycle" if circular else "root" if parent[unit] is None else "child" if parent[unit] in parent else "orphan"
    rows = [*parent.items(), (None, 3), (700, 99999)]
    above, found = h.ancestor_closure(spark.createDataFrame(rows, "c int, p int"), "c", "p", str(tmp_path))
    assert sorted(map(tuple, above.collect())) == sorted(ancestors)
    assert {r["code"]: r["standing"] for r in found.collect()} == standing
    assert set(standing.values()) == {"cycle", "root", "child", "orphan"}
    above, found = h.ancestor_closure(spark.createDataFrame([], "c int, p int"), "c", "p", str(tmp_path))
    assert above.count() == 0 and found.count() == 0


def test_keys_stay_and_do_not_meet(spark, tmp_path):
    folder = f"{tmp_path}/keys"
    assert zlib.crc32(b"plumless") == zlib.crc32(b"buckeroo")
    make = lambda rows: spark.createDataFrame(rows, "a string, b int")
    assert keymap.add_keys(make([]), ["a", "b"], folder).count() == 0
    first = [("plumless", 1), ("buckeroo", 1), (None, 1), ("x", None), ("x", 2)]
    ids = lambda df: {(r["a"], r["b"]): r["id"] for r in df.collect()}
    one = ids(keymap.add_keys(make(first * 3), ["a", "b"], folder))
    assert sorted(one.values()) == [1, 2, 3, 4, 5] and set(one) == set(first)
    more = [(f"n{i}", i) for i in range(500)] + first[:3]
    two_map = keymap.add_keys(make(more), ["a", "b"], folder)
    two = ids(two_map)
    assert {k: two[k] for k in one} == one and sorted(two.values()) == list(range(1, 506))
    assert ids(keymap.add_keys(make(more), ["a", "b"], folder)) == two
    keyed = keymap.with_keys(make([*first, ("new", 0)]), two_map, ["a", "b"]).collect()
    assert [r["id"] for r in keyed if r["a"] == "new"] == [None]
    assert all(r["id"] == two[r["a"], r["b"]] for r in keyed if r["a"] != "new")


def test_table_diff_and_what_it_reads(spark, tmp_path):
    rng = random.Random(6)
    left = [(k, day(rng.randrange(12)) if k % 40 else None, rng.randrange(3)) for k in range(400)] + [(None, day(3), 1), (7, day(3), 9), (7, day(3), 9)]
    right = [r for r in left if r[1] != day(5) or r[0] % 3]
    right = [(k, d, 100 if d == day(8) and k % 4 == 0 else x) for k, d, x in right] + [(1000, day(8), 1), (None, day(8), 2)]
    right.remove((7, day(3), 9))  # one of two equal rows
    expected = set()
    for key in {(k, d) for k, d, _ in left + right}:
        a, b = (Counter(x for k, d, x in side if (k, d) == key) for side in (left, right))
        if a != b:
            expected.add((*key, "added" if not a else "removed" if not b else "changed"))
    frames = [spark.createDataFrame(rows, "k int, partitiondate date, x int") for rows in (left, right)]
    got = t.table_diff(*frames, "k")
    assert {tuple(r) for r in got.collect()} == expected and len(expected) > 10
    assert got.count() == len(expected)

    paths = [f"{tmp_path}/{name}" for name in ("left", "right")]
    for frame, path in zip(frames, paths, strict=True):
        frame.where("partitiondate is not null").write.partitionBy("partitiondate").parquet(path)
    out = t.table_diff(*[spark.read.parquet(p) for p in paths], "k")
    assert {tuple(r) for r in out.collect()} == expected
    scans = [x for x in final_plan_of(out).split("\n") if "FileScan" in x]
    assert scans and all(str(day(8)) in x and str(day(1)) not in x for x in scans)
    same = t.table_diff(frames[0], frames[0].orderBy(F.desc("x")), "k")
    assert same.count() == 0
