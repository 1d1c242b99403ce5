"""Operators on small written-out cases."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from querybook.base import LINE_CLASSES
from tests.conftest import final_plan_of, plan_of
from tidemark.functions import keys, periods as p
from tidemark.operators import business_days, densify, flags, joins, latest, lifecycle
from tidemark.operators import money as m
from tidemark.operators import objectives as o
from tidemark.operators import scores, shaping

REF = date(2024, 3, 13)


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- flags -------------------------------------------------------------------------


def expected_flags(rule):
    return [rule(unit, n) for _, unit, n in p.FLAG_PERIODS]


@pytest.fixture(scope="module")
def days():
    rng = random.Random(3)
    return [REF + timedelta(days=rng.randrange(-500, 40)) for _ in range(300)] + [None]


def flagged(df, name):
    return {r["d"]: [r[f] for f in p.flag_names(name)] for r in df.collect()}


def test_in_period_flags(rows, days):
    got = flagged(flags.in_period_flags(rows("d date", [(d,) for d in days]), "d", REF, "x"), "x")
    for d, values in got.items():
        if d is None:
            assert values == [None] * 10
        else:
            rule = lambda u, n: p.period_start(d, u) == p.period_bounds(REF, u, n).start  # noqa: B023, E731
            assert values == expected_flags(rule)


def test_closed_by_and_rolling_flags(rows, days):
    frame = rows("d date", [(d,) for d in days if d])
    closed = flagged(flags.closed_by_flags(frame, "d", REF, "x"), "x")
    active = flagged(flags.rolling_activity_flags(frame, "d", REF, "x"), "x")
    for d in closed:
        close = {(u, n): p.close_date(REF, u, n) for _, u, n in p.FLAG_PERIODS}
        assert closed[d] == [d <= close[u, n] for _, u, n in p.FLAG_PERIODS]
        assert active[d] == [0 <= p.months_between(close[u, n], d) <= 3 for _, u, n in p.FLAG_PERIODS]


def test_active_at_close_is_half_open(rows):
    frame = rows("a date, b date", [(date(2024, 1, 1), date(2024, 2, 29)), (date(2024, 2, 29), date(2024, 3, 14))])
    got = flags.active_at_flags(frame, "a", "b", REF, "x").orderBy("a").collect()
    # the month of February closes on the 29th: the first has ended, the second has begun
    assert [r.is_x_m_1 for r in got] == [False, True]
    assert [r.is_x_m for r in got] == [False, True]
    assert [r.is_x_m_2 for r in got] == [True, False]


def test_rollup_and_fill(rows):
    frame = rows("k int, d date", [(1, REF), (1, date(2023, 5, 1)), (2, date(2020, 1, 1)), (3, None)])
    rolled = flags.rollup_flags(flags.in_period_flags(frame, "d", REF, "x"), "k", "x")
    got = {r.k: r for r in flags.fill_flags(rolled, "x").collect()}
    assert (got[1].is_x_s, got[1].is_x_y, got[1].is_x_y_1) == (1, 1, 1)
    assert got[2].is_x_y_1 == 0 and got[3].is_x_s == 0


def test_event_counts_ignore_repeated_events(rows):
    t = datetime(2024, 3, 13, 10)
    events = rows(
        "k int, ts timestamp_ntz, snap date",
        [(1, t, REF), (1, t, REF), (1, t + timedelta(hours=1), REF), (1, datetime(2024, 3, 11), REF),
         (1, datetime(2024, 3, 1), REF), (1, datetime(2023, 3, 13), REF)],
    )
    got = flags.event_counts(events, "k", "ts", "snap").collect()[0]
    assert (got.events_day, got.events_week, got.events_month) == (2, 3, 4)


def test_recency_is_false_when_unknown(rows):
    frame = rows("d date", [(REF - timedelta(days=30),), (REF - timedelta(days=31),), (None,), (REF + timedelta(days=1),)])
    got = frame.select("d", flags.recency_column("d", 30, REF)).collect()
    assert [r.is_active_30d for r in got] == [True, False, False, False]


def test_previous_business_day(rows):
    # 2024-03-18 is a Monday; the Friday before and the Thursday are holidays
    frame = rows("id int, d date", [(1, date(2024, 3, 18)), (2, date(2024, 3, 20)), (3, date(2024, 3, 18)), (4, None)])
    holidays = rows("holiday date", [(date(2024, 3, 15),), (date(2024, 3, 14),)])
    got = {r.id: r.business_day for r in business_days.previous_business_day(frame, holidays, "d").collect()}
    assert got == {1: date(2024, 3, 13), 2: date(2024, 3, 19), 3: date(2024, 3, 13), 4: None}
    # all days of a long holiday are closed: the row stays, and a wider window finds a day
    closed = rows("holiday date", [(date(2024, 3, 17) - timedelta(days=i),) for i in range(12)])
    found = business_days.previous_business_day(frame.where("id = 1"), closed, "d").first()
    assert (found.id, found.business_day) == (1, None)
    wide = business_days.previous_business_day(frame.where("id = 1"), closed, "d", window=14).first()
    assert wide.business_day == date(2024, 3, 5)


# --- groups ------------------------------------------------------------------------


def test_extremes_keep_ties_and_null_keys(rows):
    frame = rows("k int, a int, b int", [(1, 5, 1), (1, 5, 2), (1, 4, 9), (None, 1, 1), (None, 3, 0), (2, None, 1)])
    assert bag(joins.keep_group_extremes(frame, "k", "a")) == bag(frame.where("a IN (5, 3)"))
    # both columns have to be the largest
    assert bag(joins.keep_group_extremes(frame, "k", ["a", "b"])) == []
    assert bag(joins.keep_group_extremes(frame, "k", "a", largest=False)) == sorted([(1, 4, 9), (None, 1, 1)], key=repr)


def test_group_totals_match_null_keys(rows):
    frame = rows("k int, v int", [(1, 1), (1, 1), (None, 7), (2, 3)])
    got = joins.with_group_totals(frame, "k", {"n": F.count_distinct("v"), "s": F.sum("v")})
    assert bag(got) == sorted([(1, 1, 1, 2), (1, 1, 1, 2), (None, 7, 1, 7), (2, 3, 1, 3)], key=repr)


def test_latest_row_is_limited_before_the_shuffle(rows):
    frame = rows("k int, d int, x string", [(1, 1, "a"), (1, 2, "c"), (1, 2, "b"), (2, None, "z")])
    newest = latest.latest_by(frame, "k", "d", ties=["x"])
    assert bag(newest) == [(1, 2, "b"), (2, None, "z")]
    assert bag(latest.latest_by(frame, "k", "d", ascending=True, ties=["x"]))[0] == (1, 1, "a")
    plan = plan_of(newest)
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_validity(rows):
    frame = rows("id int, dfval date, snap date", [(1, REF, REF), (2, REF + timedelta(days=1), REF)])
    assert [r.id for r in latest.valid_at(frame, REF).collect()] == [2]
    assert [r.id for r in latest.valid_at(frame, REF, inclusive=True).collect()] == [1, 2]
    assert [r.id for r in latest.valid_at(frame, F.col("snap")).collect()] == [2]


# --- gaps ----------------------------------------------------------------------------


def test_fill_prefers_the_next_value(rows):
    frame = rows("k int, d int, x int", [(1, 1, None), (1, 2, 5), (1, 3, None), (1, 4, 8), (1, 5, None), (2, 1, None)])
    got = {(r.k, r.d): r.x for r in densify.fill_nulls_bidirectional(frame, ["x"], "k", "d").collect()}
    assert got == {(1, 1): 5, (1, 2): 5, (1, 3): 8, (1, 4): 8, (1, 5): 8, (2, 1): None}


def test_expected_dates(rows):
    frame = rows("d date", [(date(2023, 12, 31),), (date(2024, 1, 3),), (date(2024, 1, 3),), (date(2024, 1, 6),)])
    got = densify.expected_dates(frame, "2024-01-05", "d").orderBy("expected_date").collect()
    jan = [date(2024, 1, i) for i in range(1, 6)]
    assert [tuple(r) for r in got] == list(zip(jan, [None, None, jan[2], jan[2], jan[2]]))


# --- money ---------------------------------------------------------------------------


def test_netting_table(rows):
    frame = rows(
        "debit int, credit int, side string",
        [(10, 4, "AA"), (None, 4, "AA"), (10, 4, "PP"), (None, None, "PP"), (10, 4, "AP"), (-1, 4, "AP"), (10, -4, "AP"), (1, 2, None), (1, 2, "XX")],
    )
    got = [(r.debit, r.credit, r.category) for r in m.classify_balances(frame, [("debit", "credit")], "side", ("EMPLOI", "RESSOURCE")).collect()]
    loan, resource = "EMPLOI", "RESSOURCE"
    assert got == [
        (6, None, loan), (-4, None, loan), (None, -6, resource), (None, 0, resource), (10, 4, resource),
        (None, 4, resource), (10, None, loan), (None, None, None), (None, None, None),
    ]


def test_rates(rows):
    notes = rows("sell int, buy int, unit int", [(10, 8, 1), (10, 8, 100), (10, 8, 0)])
    # sell plus half of buy
    assert [r.rate for r in m.unit_rates(notes, sell="sell", buy="buy").collect()] == [14.0, 0.14, None]
    average = lambda sell, buy, unit: F.try_divide((sell + buy) / 2, unit)
    assert [r.rate for r in m.unit_rates(notes, sell="sell", buy="buy", note_rate=average).collect()][0] == 9.0


def test_prefix_classes_take_the_longest_prefix(rows):
    frame = rows("id int, c string, d string", [(1, "6141", "6119"), (1, "6141", "6119"), (2, None, "6299"), (3, None, None)])
    got = bag(m.classify_prefix(frame, ["id"], "c", "d", LINE_CLASSES, "OTHER", ("IN", "OUT")))
    assert got == [(1, "6119", "OUT", "CLASS 61"), (1, "6141", "IN", "CLASS 614"), (2, "6299", "OUT", "OTHER")]


def test_conversion(spark, rows):
    frame = rows(
        "id int, currency string, kind string, amount int",
        [(1, "000C", "VIREMENT", 5), (2, "EUR", "VIREMENT", 5), (3, "EUR", "BILLET", 5), (4, "GBP", "BILLET", 5)],
    )
    # The home currency may be quoted, even twice: its rows need no rate and stay single.
    quoted = [("EUR", 10.0, 9.0, 13.0), ("000C", 7.0, 7.0, 7.0), ("000C", 8.0, 8.0, 8.0)]
    rates = rows("currency string, mid double, low double, high double", quoted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        out = m.convert_amounts(frame, rates, ["amount"], home="000C", wire_kind="VIREMENT")
        got = sorted((r.id, r.amount_home and float(r.amount_home)) for r in out.collect())
        assert got == [(1, 5.0), (2, 50.0), (3, 55.0), (4, None)]
        flows = frame.selectExpr("id as a", "date'2024-01-05' as d", "currency", "100 * amount as v", "'C' as s")
        daily = rates.selectExpr("*", "date'2024-01-05' as quote_date")
        summed = m.credit_flow(flows, daily, "a", "d", "currency", "v", "s", home="000C")
        assert {r.account: float(r.credit_flow) for r in summed.collect()} == {1: 5.0, 2: 50.0, 3: 50.0, 4: 0.0}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_filling_takes_time_in_proportion(spark):
    """Both directions are running frames; none looks at all rows that follow."""
    series = spark.range(40_000).select(F.lit(1).alias("k"), F.col("id").alias("d"), F.when(F.col("id") % 1000 == 500, F.col("id")).alias("v"))
    filled = densify.fill_nulls_bidirectional(series, ["v"], "k", "d")
    assert "unboundedfollowing" not in plan_of(filled).lower()
    assert filled.where("v <> case when d > 39500 then 39500 else 1000 * floor((d + 499) / 1000) + 500 end").count() == 0


def test_sums_since_keep_keys_without_recent_movements(rows):
    frame = rows("a int, d date, v int", [(1, date(2020, 1, 1), 5), (2, REF, 3)])
    got = {r.a: (r.sum_y, r.sum_y_1) for r in m.sums_since(frame, "a", "d", F.col("v"), m.since_bounds(REF)).collect()}
    assert got == {1: (0, 0), 2: (3, 3)}
    assert m.since_bounds("2024-05-15") == {
        "s": date(2024, 5, 13), "s_1": date(2024, 5, 6), "m": date(2024, 5, 1), "m_1": date(2024, 4, 1),
        "m_2": date(2024, 3, 1), "t": date(2024, 4, 1), "t_1": date(2024, 1, 1), "y": date(2024, 1, 1), "y_1": date(2023, 10, 1),
    }


def test_dense_months_weight_snapshots(rows):
    frame = rows(
        "k int, c string, d date, x int",
        [(1, "a", date(2024, 1, 10), 2), (1, "a", date(2024, 2, 2), 5), (2, "a", date(2023, 7, 1), 9)],
    )
    got = bag(m.monthly_balance_dense(frame, "2024-02-03", ["k"], ["c"], "d", ["x"]))
    # 10..31 January and 1 February stand for the first snapshot, 2 and 3 February for the second
    assert got == sorted([(1, "202401", "a", 44, 31), (1, "202402", "a", 2 + 10, 29), (2, None, "a", 9, None)], key=repr)


def test_monthly_balance_counts_dropped_rows(rows):
    frame = rows("k int, c string, d date, x int", [(1, "a", REF, 2), (1, "b", REF, 0), (1, "b", REF, None)])
    assert bag(m.monthly_balance(frame, ["k"], ["c"], "d", ["x"])) == [(1, "202403", "a", 2, 3)]


def test_positions_take_the_latest_price(rows):
    positions = rows("account int, security int, quantity int", [(1, 7, 3), (1, 7, 2), (2, 8, 4), (3, 7, -1)])
    securities = rows("security int, isin string", [(7, "A"), (7, "B"), (8, "C")])
    quotes = rows("isin string, quote_date int, price double", [("A", 1, 99.0), ("A", 2, 1.25), ("A", 2, 1.5), ("B", 1, 2.0), ("C", 1, 5.0)])
    got = bag(m.value_positions(positions, securities, quotes, "account", priced_at_zero=["C"]).select("account", "security", "value"))
    assert got == [(1, 7, 10.0)]


# --- objectives ------------------------------------------------------------------------


def test_bands(rows):
    weeks = rows("w int", [(w,) for w in (0, 1, 4, 5, 13, 14, 48, 49, 53)])
    got = weeks.select(o.band(F.col("w"), o.MONTH_LAST_WEEK).alias("m"), o.band(F.col("w"), o.QUARTER_LAST_WEEK).alias("q")).collect()
    assert [r.m for r in got] == [None, 1, 1, 2, 3, 4, 11, 12, 12]
    assert [r.q for r in got] == [None, 1, 1, 1, 1, 2, 4, 4, 4]


def test_split_needs_no_exchange_of_weeks(rows):
    data = [(2024, w, Decimal("0.0188"), Decimal("0.0188") * w) for w in range(1, 54)]
    season = rows("year int, week int, pct_week decimal(9,4), pct_cum decimal(9,4)", data)
    objectives = rows("unit int, year int, annual decimal(18,2)", [(1, 2024, Decimal("1000.00")), (2, 2023, Decimal("5.00"))])
    split = o.seasonal_split(objectives, season)
    got = {r.week: r for r in split.collect()}
    assert len(got) == 53
    assert (float(got[1].weekly), float(got[1].monthly), float(got[1].quarterly)) == (18.8, 75.2, 244.4)
    assert (got[53].month, got[53].quarter, float(got[53].cumulative)) == (12, 4, 996.4)
    assert "Window" not in plan_of(split)


# --- shaping -----------------------------------------------------------------------------


def test_keys(rows):
    frame = rows("a string, b string", [(" X ", "y"), ("x", "Y"), ("", None), ("x", None)])
    got = [r[0] for r in frame.select(keys.primary_key("a", "b")).collect()]
    assert got[0] == got[1] and got[2] is None and got[3] not in (None, got[0])


def test_unknown_members(rows):
    dimension = rows("id int, name string, since date", [(1, "a", REF)])
    assert bag(shaping.with_unknown_member(dimension))[0] == (-1, "-1", None)
    assert bag(shaping.fill_unknown(rows("id int, name string", [(None, None)]))) == [(-1, "-1")]


def test_fallback_does_not_multiply_known_rows(rows):
    frame = rows("k int, j int", [(1, 1), (2, 1), (3, 9)])
    first = rows("k int, v string", [(1, None)])
    second = rows("j int, v string", [(1, "s1"), (1, "s2")])
    got = bag(shaping.enrich_with_fallback(frame, first, second, {"k": "k"}, {"j": "j"}, ["v"]))
    # row 1 is known to the first table, though without a value
    assert got == sorted([(1, 1, None, 1), (2, 1, "s1", 2), (2, 1, "s2", 2), (3, 9, None, None)], key=repr)


def test_unmatched_keeps_null_keys(rows):
    frame = rows("k int", [(1,), (2,), (None,)])
    got = shaping.unmatched_rows(frame, [(rows("r int", [(1,), (None,)]), {"k": "r"})])
    assert bag(got) == sorted([(2,), (None,)], key=repr)


def test_json_with_spaces_and_errors(rows):
    schema = T.StructType([T.StructField("id Tiers", T.StringType()), T.StructField("n", T.IntegerType())])
    frame = rows("i int, j string", [(1, '{"id Tiers": "x", "n": 3}'), (2, "no json"), (3, None)])
    got = bag(shaping.parse_json(frame, "j", schema, {"id Tiers": "customer"}))
    assert got == sorted([(1, "x", 3), (2, None, None), (3, None, None)], key=repr)


def test_hierarchy(rows):
    units = rows(
        "code string, name string, grp string, region string",
        [("a", "A", None, "r"), ("b", "B", "a", "r"), ("r", "R", None, None), ("x", "X", "a", "unknown")],
    )
    got = {r.code: r for r in shaping.flatten_hierarchy(units, "code", "name", {"grp": "grp", "region": "region"}, ["grp"]).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"].grp_code, got["a"].grp_name) == ("a", "A")
    assert (got["b"].grp_code, got["b"].grp_name, got["b"].region_name) == ("a", "A", "R")


def test_route_names_the_first_rule(rows):
    frame = rows("v int", [(1,), (5,), (50,), (None,)])
    got = shaping.route(frame, {"big": F.col("v") > 10, "some": F.col("v") > 3})
    assert bag(got) == [(5, "some"), (50, "big")]


def test_pivot_fills_counts_only(rows):
    frame = rows("k int, t string, v int", [(1, "a", 4), (1, "a", 6), (2, "c", 1)])
    got = {r.k: r for r in shaping.pivot_counts(frame, "k", "t", ["a", "b"], {"n": F.count("v"), "top": F.max("v")}, ["n"]).collect()}
    assert (got[1].a_n, got[1].a_top, got[1].b_n, got[1].b_top) == (2, 6, 0, None)
    assert got[2].a_n == 0


# --- lifecycle and scores ------------------------------------------------------------------


def test_churn_needs_every_account_closed(rows):
    frame = rows(
        "k int, open boolean, closed date, snap date",
        [(1, False, REF, REF), (1, False, date(2020, 1, 1), REF), (2, True, None, REF), (2, False, REF, REF), (3, None, REF, REF)],
    )
    flagged_rows = lifecycle.churn_flags(frame, "k", F.col("open"), "closed", "snap").collect()
    got = {r.k: (r.all_closed, r.churned_week, r.churned_year) for r in flagged_rows}
    assert got == {1: (1, 1, 1), 2: (0, 0, 0), 3: (0, 0, 0)}


def test_transitions_treat_unknown_as_not_active(rows):
    frame = rows("s string, prev_week_s string", [("A", None), ("A", "A"), ("A", "I"), (None, "A"), ("I", "A"), ("I", None)])
    up = [r.reactivated_week for r in lifecycle.transition_flags(frame, "reactivated", "s", "A", ["week"]).collect()]
    down = [r.inactivated_week for r in lifecycle.transition_flags(frame, "inactivated", "s", "A", ["week"]).collect()]
    assert (up, down) == ([1, 0, 1, 0, 0, 0], [0, 0, 0, 1, 1, 0])


def test_tenure_ladder(rows):
    opened = [date(2024, 3, 1), date(2024, 2, 20), date(2024, 1, 5), date(2023, 11, 30), date(2023, 10, 1)]
    frame = rows("opened date, a int, b int, c int", [(d, 1, 0, 0) for d in opened] + [(opened[4], 1, 0, 1), (None, 1, 1, 1)])
    got = scores.tenure_score(frame, "opened", ["a", "b", "c"], REF).collect()
    assert [r.tenure_months for r in got] == [0, 0, 1, 3, 4, 4, None]
    assert [r.tenure_score for r in got] == [0, 0, 1, 0, 0, 1, 0]


def test_score_lookup_compares_decimals(rows):
    frame = rows("s double, t double", [(0.1 + 0.2, 1.0), (0.5, 1.0), (0.5, 9.0)])
    rules = rows("s float, t string, level int", [(0.3, "1.0", 7), (0.5, "1", 8)])
    got = scores.score_lookup(frame, rules, ["s", "t"]).collect()
    assert [r.level for r in got] == [7, 8, None]
    text = rows("x string", [("0,5",), ("abc",)])
    assert [r[0] and float(r[0]) for r in text.select(scores.decimal_comma("x")).collect()] == [0.5, None]


# --- skew ----------------------------------------------------------------------------------


@pytest.fixture
def skew_settings(spark):
    """Makes a local run behave as a large one: no broadcast, small skew limits."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "200k",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_rows(spark, tmp_path):
    """One key has half of the rows; several files, so the shuffle has many maps."""
    key = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id"))
    path = str(tmp_path / "hot")
    spark.range(0, 60000, 1, 8).select(key.alias("k"), F.col("id"), (F.col("id") * 7 % 1000).alias("v")).write.parquet(path)
    return spark.read.parquet(path)


def test_hot_key_in_group_totals_is_split(spark, skew_settings, tmp_path):
    hot = hot_rows(spark, tmp_path)
    out = joins.with_group_totals(hot, "k", {"n": F.count("*"), "top": F.max("v")})
    plan = final_plan_of(out)
    assert "skew=true" in plan
    assert out.where("k = 0 AND n <> 30000").count() == 0 and out.count() == 60000


def test_hot_key_in_extremes_is_spread_and_whole(spark, skew_settings, tmp_path):
    """The join is on key and value, which spreads a hot key; ties are split."""
    hot = hot_rows(spark, tmp_path)
    out = joins.keep_group_extremes(hot, "k", "v")
    assert out.where("k = 0").count() == hot.where("k = 0 AND v = 998").count() > 1
    tied = joins.keep_group_extremes(hot.withColumn("v", F.lit(1)), "k", "v")
    assert "skew=true" in final_plan_of(tied)
    assert tied.count() == 60000


def test_home_currency_is_spread(spark, skew_settings, rows):
    frame = spark.range(0, 20000, 1, 8).select(
        "id", F.lit("000C").alias("currency"), F.lit("VIREMENT").alias("kind"), F.lit(0).alias("amount")
    )
    rates = rows("currency string, mid double, low double, high double", [("EUR", 10.0, 9.0, 13.0)])
    out = m.convert_amounts(frame, rates, ["amount"], home="000C", wire_kind="VIREMENT")
    sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 20000 / 8 * 1.5
