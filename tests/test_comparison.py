import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tidemark.functions import periods as p
from tidemark.operators import comparison as c

REF = date(2024, 3, 13)


def random_history(seed, keys=12):
    """Rows per key and day with gaps, null values and a key without rows near the end."""
    rng = random.Random(seed)
    rows = []
    for key in range(keys):
        day = date(2021, 12, 20)
        while day <= date(2024, 5, 1):
            if rng.random() < 0.25:
                value = None if rng.random() < 0.2 else rng.randrange(1000)
                rows.append((key, day, value))
            day += timedelta(days=rng.choice((1, 1, 2, 9, 40) if key % 3 else (1, 3)))
    have = {(k, d) for k, d, _ in rows}
    rows += [(k, REF, k * 10) for k in range(0, keys, 2) if (k, REF) not in have]
    rng.shuffle(rows)
    return rows


def by_key(rows):
    out = {}
    for key, day, value in sorted(rows, key=lambda r: (r[0], r[1])):
        out.setdefault(key, []).append((day, value))
    return out


def running(series, unit, n):
    """The rule stated row by row: remember the value before a period change when
    that earlier period is n units before the reference date's."""
    kept, out = None, {}
    for i, (day, _) in enumerate(series):
        if i:
            before, value = series[i - 1]
            changed = p.period_start(before, unit) != p.period_start(day, unit)
            target = p.period_bounds(REF, unit, n).start
            if changed and p.period_start(before, unit) == target and value is not None:
                kept = value
        out[day] = kept
    return out


def observed(series, unit):
    kept, out = None, {}
    for i, (day, _) in enumerate(series):
        if i:
            before, value = series[i - 1]
            if p.period_start(before, unit) != p.period_start(day, unit) and value is not None:
                kept = value
        out[day] = kept
    return out


def collected(df, column):
    return {(r["k"], r["day"]): r[column] for r in df.collect()}


@pytest.fixture(scope="module")
def data():
    return random_history(7)


@pytest.fixture
def frame(spark, data):
    return spark.createDataFrame(data, "k int, day date, x int")


@pytest.mark.parametrize("unit, n", [("month", 1), ("month", 2), ("year", 1), ("year", 2), ("week", 1), ("week", 3)])
def test_previous_period_value(frame, data, unit, n):
    got = collected(c.prev_period_value(frame, "x", REF, [(unit, n)], "k", "day"), c.past_name("x", unit, n))
    for key, series in by_key(data).items():
        for day, value in running(series, unit, n).items():
            assert got[key, day] == value, (key, day)


@pytest.mark.parametrize("unit", p.UNITS)
def test_previous_observed_period(frame, data, unit):
    got = collected(c.prev_observed_period_value(frame, "x", unit, "k", "day"), f"last_{unit}_x")
    exact = collected(c.prev_observed_period_value(frame, "x", unit, "k", "day", exact=True), f"last_{unit}_x")
    for key, series in by_key(data).items():
        expected = observed(series, unit)
        ends = {p.period_start(day, unit): value for day, value in series}
        for day, _ in series:
            assert got[key, day] == expected[day]
            directly = p.period_start(p.period_start(day, unit) - timedelta(days=1), unit)
            assert exact[key, day] == ends.get(directly)


def test_same_day_last_year(frame, data):
    got = collected(c.same_day_last_year(frame, "x", REF, "k", "day"), "same_day_last_year_x")
    then = p.shift_back(REF, "year", 1)
    for key, series in by_key(data).items():
        value = dict(series).get(then)
        for day, _ in series:
            assert got[key, day] == (value if day >= then else None)


def test_window_form_equals_aggregation_form(frame, data):
    periods = [("week", 1), ("month", 1), ("month", 2), ("quarter", 1), ("year", 1)]
    today = c.prev_period_value(frame, "x", REF, periods, "k", "day").where(F.col("day") == F.lit(REF))
    names = ["x", *[c.past_name("x", u, n) for u, n in periods]]
    window = {r["k"]: [r[n] for n in names] for r in today.collect()}
    as_of = {r["k"]: [r[n] for n in names] for r in c.values_as_of(frame, "x", REF, periods, "k", "day").collect()}
    assert window and all(as_of[k] == values for k, values in window.items())


def test_as_of_propagation_equals_the_window_form(frame):
    periods = [("month", 1), ("month", 2), ("week", 1), ("year", 1)]
    window = c.propagate_balances(frame, ["x"], REF, "k", "day", periods=periods)
    window = window.where(F.col("day") == F.lit(REF))
    as_of = c.propagate_as_of(frame, ["x"], REF, "k", "day", periods=periods)
    assert sorted(as_of.columns) == sorted(window.columns)
    ours = sorted((tuple(r) for r in as_of.select(window.columns).collect()), key=repr)
    assert ours and ours == sorted((tuple(r) for r in window.collect()), key=repr)
    assert "WindowGroupLimit" in plan_of(as_of)


def test_values_as_of_reads_only_the_periods(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    daily = c.daily_totals(orders, "o_custkey", "o_orderdate", {"x": F.col("o_totalprice")})
    plan = plan_of(c.values_as_of(daily, "x", "2001-06-15", [("month", 1)], "o_custkey", "day"))
    assert "GreaterThanOrEqual(o_orderdate,2001-05-01" in plan
    assert "Sort" not in plan and "Window" not in plan


def test_all_columns_share_one_exchange_and_sort(frame):
    plan = plan_of(
        c.propagate_balances(
            frame, ["x"], REF, "k", "day", observed=["week", "quarter"],
            periods=[("month", n) for n in (1, 2, 3, 4)] + [("week", 1), ("year", 1)],
        )
    )
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    with_delta = plan_of(c.variation_kpis(frame, "x", REF, "k", "day"))
    assert with_delta.count("Exchange hashpartitioning") == 1
    assert with_delta.count("Sort [") == 1


def test_variation_rules(rows):
    df = rows("now int, base int", [(5, 3), (None, 3), (5, None), (None, None), (4, 0)])
    got = df.select(
        c.difference(F.col("now"), F.col("base")).alias("unsigned"),
        c.difference(F.col("now"), F.col("base"), "zero").alias("zero"),
        c.ratio(c.difference(F.col("now"), F.col("base")), F.col("base")).alias("pct"),
    ).collect()
    assert [r.unsigned for r in got] == [2, 3, 5, 0, 4]
    assert [r.zero for r in got] == [2, -3, 5, 0, 4]
    assert [r.pct for r in got] == [2 / 3, 1.0, None, None, None]


def test_state_decoding(rows):
    history = rows(
        "k int, day date, state string",
        [(1, date(2024, 1, 30), "0"), (1, date(2024, 1, 31), "3"), (1, date(2024, 2, 1), "1"),
         (1, date(2024, 2, 20), "0"), (1, date(2024, 4, 1), "9")],
    )
    got = c.prev_observed_state(
        history, "state", ["month"], "k", "day", decode={"VALID": ["0", "1"], "ENDED": ["3"]}, default="OTHER"
    ).orderBy("day").collect()
    assert [r.prev_month_state for r in got] == [None, None, "ENDED", "ENDED", "VALID"]


def test_daily_totals_combine_before_the_shuffle(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = plan_of(c.daily_totals(lines, "l_suppkey", "l_shipdate", {"x": F.col("l_extendedprice")}))
    assert "partial_sum" in plan and plan.count("Exchange") == 1
