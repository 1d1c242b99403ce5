import random
from collections import Counter, defaultdict

import pytest

from tidemark.llm.mixing import in_mixed_order, mixed, whole_parts


def edf(parts, rows, block_rows):
    """[(stream, block)] slot by slot, by the definition."""
    total = sum(parts)
    left = [-(-r // block_rows) for r in rows]
    done, out, t = [0] * len(parts), [], 0
    while any(d < n for d, n in zip(done, left, strict=True)):
        # A period starts with the streams that have rows then; the slots of blocks that do
        # not exist any more stay free.
        if t % total == 0:
            base = list(done)
            active = [d < n for d, n in zip(done, left, strict=True)]
        ready = [
            (-(-(i + 1) * total // w), j)
            for j, w in enumerate(parts)
            if active[j] and (i := done[j]) < base[j] + w and i * total // w <= t
        ]
        if ready:
            j = min(ready)[1]
            if done[j] < left[j]:
                out.append((j, done[j], t))
            done[j] += 1
        t += 1
        if t % total == 0:
            done = [b + w if a else b for a, b, w in zip(active, base, parts, strict=True)]
            done = [min(d, n) if a else d for d, n, a in zip(done, left, active, strict=True)]
    return out


def frame(docs, counts):
    rows = [(i, s) for s, n in counts.items() for i in range(n)]
    random.Random(1).shuffle(rows)
    made = docs([(k, f"t{k}") for k in range(len(rows))])
    names = [s for _, s in rows]
    from pyspark.sql import functions as F

    pick = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("doc_id") + 1).cast("int"))
    return made.withColumn("source", pick)


@pytest.mark.parametrize("block_rows", [1, 3])
def test_same_as_the_definition(docs, block_rows):
    counts = {"a": 61, "b": 20, "c": 9, "x": 14, None: 5}
    weights = {"a": 0.5, "b": 0.3, "c": 0.15, "other": 0.05}
    parts = whole_parts(weights, 20)
    assert parts == {"a": 10, "b": 6, "c": 3, "other": 1}
    out = mixed(frame(docs, counts), weights, block_rows=block_rows, parts=20).collect()
    rows = [61, 20, 9, 19]
    expected = edf(list(parts.values()), rows, block_rows)
    assert sorted({(r.mix_slot, r.mix_stream, r.mix_block) for r in out}) == sorted((t, j, b) for j, b, t in expected)
    assert sorted(r.mix_position for r in out) == list(range(sum(rows)))
    inner = defaultdict(list)
    for r in sorted(out, key=lambda r: r.mix_position):
        inner[r.mix_stream].append(r.doc_id)
        assert r.mix_release <= r.mix_slot < r.mix_due
    assert all(ids == sorted(ids) for ids in inner.values())
    by_slot = [r.mix_slot for r in sorted(out, key=lambda r: r.mix_position)]
    assert by_slot == sorted(by_slot)


def test_less_than_one_block_from_the_weights(docs):
    weights = {f"s{i}": 1 + i % 7 for i in range(19)} | {"other": 2}
    parts = whole_parts(weights, 200)
    # Every source lasts as long as its weight says.
    frame_ = frame(docs, {s if s != "other" else "zz": n for s, n in parts.items()})
    out = mixed(frame_, weights, block_rows=1, parts=200).collect()
    seen, names = Counter(), list(parts)
    for t, r in enumerate(sorted(out, key=lambda r: r.mix_position), start=1):
        seen[names[r.mix_stream]] += 1
        for s, w in parts.items():
            assert abs(seen[s] - w * t / 200) < 1


def test_rows_and_columns_stay_and_order_is_laid_out(docs, spark, tmp_path):
    weights = {"a": 0.7, "b": 0.2}
    given = frame(docs, {"a": 300, "b": 40, "c": 3}).selectExpr("*", "1 as mix_slot", "2 as phase", "3 as slot", "4 as before", "5 as nth", "6 as s")
    out = in_mixed_order(given, weights)
    assert out.columns == given.columns
    got = out.select("doc_id").collect()
    places = {r.doc_id: r.mix_position for r in mixed(given, weights).collect()}
    assert [places[r.doc_id] for r in got] == sorted(places.values())
    assert in_mixed_order(docs([]), weights).collect() == []
    assert mixed(docs([]), weights).collect() == []


def test_null_and_repeated_ids(docs):
    given = docs([(None, "a"), (None, "b"), (1, "c"), (1, "c")])
    out = mixed(given, {"s": 1.0, "t": 1.0}).collect()
    assert sorted(r.mix_position for r in out) == [0, 1, 2, 3]


def test_weights_become_whole_parts():
    assert sum(whole_parts({"a": 1, "b": 1, "c": 1}).values()) == 1000
    assert whole_parts({"a": 1.0, "other": 1e-9})["other"] == 1
    with pytest.raises(ValueError):
        whole_parts({"a": 0.0})


def test_no_python(docs):
    from tests.conftest import final_plan_of

    plan = final_plan_of(mixed(docs([(1, "a"), (2, "b")]), {"s": 1.0}))
    assert "Python" not in plan and "Arrow" not in plan


def test_every_source_gets_its_own_stream(docs):
    from tidemark.llm.mixing import own_weights

    given = frame(docs, {"a": 40, "b": 30, "c": 20, "d": 6, None: 4})
    weights = own_weights(given, {"a": 0.4, "other": 0.6})
    assert weights == pytest.approx({"a": 0.4, "b": 0.3, "c": 0.2, "d": 0.06, "other": 0.04})
    assert own_weights(given, {"a": 0.4, "other": 0.6}, most=2) == pytest.approx({"a": 0.4, "b": 0.3, "c": 0.2, "other": 0.1})
    assert own_weights(docs([]), {"a": 0.4, "other": 0.6}) == {"a": 0.4, "other": 0.6}
    out = in_mixed_order(given, weights, block_rows=1, places=True)
    assert set(given.columns) < set(out.columns)
    rows = out.collect()
    assert [r.mix_position for r in rows] == list(range(100))
    # A source whose ids lie together is spread over the mix.
    assert max(r.mix_position for r in rows if r.source == "b") > 90


def test_the_query_lays_out_whole_documents(spark):
    from tidemark.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{sf}/documents.parquet")
    out = QUERIES["op4_mixing"](spark, sf).collect()
    assert len({r.mix_stream for r in out}) == given.select("source").distinct().count()
    assert [r.mix_position for r in out] == list(range(given.count()))
    assert {r.doc_id: r.text for r in out} == {r.doc_id: r.text for r in given.collect()}


def test_two_hundred_sources_keep_their_bounds(docs):
    from tidemark.llm.mixing import own_weights

    given = frame(docs, {f"s{i:03d}": 3 + i % 4 for i in range(200)})
    weights = own_weights(given, {"other": 1.0})
    assert len(weights) == 200 and "other" not in weights
    rows = in_mixed_order(given, weights, block_rows=1, places=True).collect()
    total = len(rows)
    assert [r.mix_position for r in rows] == list(range(total)) and len({r.mix_stream for r in rows}) == 200
    # Every source is nowhere a block from its share of the slots, as long as all have rows.
    parts = 1000
    share = whole_parts({**weights, "other": 1e-9}, parts)
    names = list(share)
    done = dict.fromkeys(names, 0)
    for r in rows:
        assert r.mix_release <= r.mix_slot < r.mix_due
        assert abs(done[names[r.mix_stream]] - share[names[r.mix_stream]] * r.mix_slot / parts) < 1
        done[names[r.mix_stream]] += 1
