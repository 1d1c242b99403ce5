"""Histories in segments against the windows and against search by hand."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_comparison import REF, random_history
from tidemark.operators import comparison as c
from tidemark.operators import segments as g


@pytest.fixture
def history(spark):
    rows = random_history(3)
    rows += [(None, date(2023, 1, 1) + timedelta(days=i), None if i % 7 == 0 else i) for i in range(400)]
    return spark.createDataFrame(rows, "k int, d date, v int")


def bag(df):
    return sorted(map(str, df.collect()))


PERIODS = [("month", 1), ("month", 2), ("week", 1), ("year", 1), ("year", 2)]


@pytest.mark.parametrize("segments", [2, 5, 40])
@pytest.mark.parametrize("hot_rows", [0, 25, 10_000])
def test_equal_to_the_window(history, hot_rows, segments, monkeypatch):
    whole = c.propagate_balances(history, "v", REF, "k", "d", periods=PERIODS, observed=["quarter"])
    monkeypatch.setattr(g.compare_in_segments, "__defaults__", (*g.compare_in_segments.__defaults__[:-1], segments))
    cut = c.propagate_balances(history, "v", REF, "k", "d", periods=PERIODS, observed=["quarter"], hot_rows=hot_rows)
    assert cut.columns == whole.columns and bag(cut) == bag(whole)


def test_each_form_takes_segments(history):
    for of in (
        lambda **x: c.lag_value(history, "v", 3, "k", "d", **x),
        lambda **x: c.prev_period_value(history, "v", REF, [("month", 1)], "k", "d", **x),
        lambda **x: c.prev_observed_period_value(history, "v", "month", "k", "d", **x),
        lambda **x: c.prev_observed_period_value(history, "v", "month", "k", "d", exact=True, **x),
        lambda **x: c.same_day_last_year(history, "v", REF, "k", "d", **x),
        lambda **x: c.variation_kpis(history, "v", REF, "k", "d", **x),
    ):
        cut, whole = of(hot_rows=10), of()
        assert bag(cut.select(whole.columns)) == bag(whole)
    states = history.withColumn("s", F.when(F.col("v") % 3 == 0, "A").when(F.col("v") % 3 == 1, "B"))
    decoded = lambda **x: c.prev_observed_state(states, "s", ["week", "year"], "k", "d", {"on": ["A"]}, "off", **x)
    assert bag(decoded(hot_rows=10)) == bag(decoded())


def test_segments_hold_ranges_of_about_equal_size(history):
    rows = g.with_segments(history, "k", "d", hot_rows=100, segments=8)
    found = rows.where("k is null").groupBy(g.SEGMENT).agg(F.min("d"), F.max("d"), F.count("*").alias("n")).orderBy(g.SEGMENT).collect()
    assert len(found) == 8 and all(30 <= r["n"] <= 70 for r in found)
    assert all(a[2] < b[1] for a, b in zip(found, found[1:], strict=False))
    light = {r["k"] for r in history.groupBy("k").count().where("count <= 100").collect()}
    cut = {r["k"] for r in rows.where(F.col(g.SEGMENT).isNotNull()).select("k").distinct().collect()}
    assert cut and light and not cut & light


def test_one_key_uses_all_tasks(spark):
    start = datetime(2020, 1, 1)
    times = spark.range(40_000).select(F.lit(1).alias("k"), (F.lit(start) + F.make_dt_interval(secs=F.col("id") * 977)).alias("at"), F.col("id").alias("v"))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        out = g.compare_in_segments(times, "k", "at", lags=[g.Lag("before", "v", 2)], hot_rows=1_000, segments=64)
        assert out.where("before <> v - 2 or (before is null and v > 1)").count() == 0
        shares = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    finally:
        spark.conf.unset(setting)
    assert len(shares) == 8 and max(shares) < 0.4 * 40_000


def plain_nearest(rows, known, prefer):
    out = []
    for i, (key, day) in enumerate(rows):
        mine = [i, key, day]
        for v in range(2):
            points = [(d, k[v]) for k0, d, *k in known if k0 == key and k[v] is not None]
            after = min(((d, -x) for d, x in points if d >= day), default=None)
            before = max(((d, x) for d, x in points if d <= day), default=None)
            after, before = after and -after[1], before and before[1]
            first, second = (after, before) if prefer == "next" else (before, after)
            mine.append(second if first is None else first)
        out.append(tuple(mine))
    return out


@pytest.mark.parametrize("prefer", ["next", "previous"])
@pytest.mark.parametrize("hot_rows", [0, 60, 10_000])
def test_nearest_known(spark, prefer, hot_rows):
    rng = random.Random(8)
    day = lambda: date(2024, 1, 1) + timedelta(days=rng.randrange(90))
    rows = [(rng.choice("aaaab"), day()) for _ in range(300)] + [("c", day()), ("z", day())]
    value = lambda: rng.choice([None, *range(50)])
    known = [(rng.choice("ab"), day(), value(), value()) for _ in range(40)] + [("c", date(2030, 1, 1), 1, None), ("q", day(), 1, 1)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, k string, d date")
    quotes = spark.createDataFrame(known, "k string, d date, x int, y int")
    out = g.nearest_known(df, quotes, "k", "d", ["x", "y"], prefer, hot_rows=hot_rows, segments=7)
    assert sorted(map(tuple, out.collect())) == sorted(plain_nearest(rows, known, prefer))


def test_nearest_known_without_rows(spark):
    df = spark.createDataFrame([("a", date(2024, 1, 1))], "k string, d date")
    none = spark.createDataFrame([], "k string, d date, x int")
    assert [r["x"] for r in g.nearest_known(df, none, "k", "d", ["x"]).collect()] == [None]
    assert g.nearest_known(df.limit(0), none, "k", "d", ["x"]).count() == 0
