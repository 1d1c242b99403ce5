from datetime import date, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import periods as p

DAYS = st.dates(date(1990, 1, 1), date(2050, 12, 31))


def spark_dates(spark, first, n):
    return spark.range(n).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("d"))


def test_bounds_and_shifts_agree_with_spark(spark):
    first = date(2023, 11, 1)
    days = spark_dates(spark, first, 500)
    for unit in p.UNITS:
        got = {r.d: r.s for r in days.select("d", p.period_of(F.col("d"), unit).alias("s")).collect()}
        for d, start in got.items():
            assert p.period_start(d, unit) == start
            end = p.period_end(d, unit)
            assert p.period_start(end, unit) == start
            assert p.period_start(end + timedelta(days=1), unit) == end + timedelta(days=1)
    for months in (-13, -12, -3, -1, 1, 12):
        got = days.select("d", F.add_months("d", months).alias("m")).collect()
        assert all(p.add_months(r.d, months) == r.m for r in got)


def test_months_between_agrees_with_spark(spark):
    close = date(2024, 5, 31)
    days = spark_dates(spark, date(2023, 12, 1), 200)
    got = days.select("d", F.months_between(F.lit(close), "d").alias("m")).collect()
    assert all(abs(p.months_between(close, r.d) - r.m) < 1e-6 for r in got)


@settings(max_examples=200, deadline=None)
@given(DAYS, st.integers(1, 40))
def test_rolling_bounds_hold_exactly_the_rule(close, months):
    low, high = p.rolling_bounds(close, months)
    assert high == close
    for d in (low, low + timedelta(days=1), close):
        assert 0 <= p.months_between(close, d) <= months
    for back in range(1, 5):
        assert p.months_between(close, low - timedelta(days=back)) > months


@settings(max_examples=200, deadline=None)
@given(DAYS, st.sampled_from(p.UNITS), st.integers(0, 8))
def test_period_bounds_are_whole_periods(day, unit, n):
    start, end = p.period_bounds(day, unit, n)
    assert start <= p.shift_back(day, unit, n) <= end
    assert p.period_bounds(start, unit).start == start
    assert p.period_bounds(end, unit).end == end


def test_week_bounds_and_number_rule(spark, rows):
    days = rows("d date", [(date(2024, 12, 29),), (date(2024, 12, 30),), (date(2025, 1, 1),)])
    got = days.select(
        "d", p.first_day_of_week(F.col("d")).alias("a"), p.last_day_of_week(F.col("d")).alias("b")
    ).collect()
    assert (got[0].a, got[0].b) == (date(2024, 12, 23), date(2024, 12, 29))
    assert (got[1].a, got[1].b) == (got[2].a, got[2].b) == (date(2024, 12, 30), date(2025, 1, 5))
    # by number, 30 December is in week 1 of 2024 and not in the week of 1 January 2025
    kept = days.where(p.same_week_by_number(F.col("d"), "2025-01-01")).collect()
    assert [r.d for r in kept] == [date(2025, 1, 1)]


def test_previous_period(spark, rows):
    days = rows("d date", [(date(2024, 1, 15),), (date(2024, 5, 31),)])
    got = days.select(
        *[p.previous_period_of(F.col("d"), u).alias(u) for u in p.UNITS]
    ).collect()
    assert got[0].month == date(2023, 12, 1) and got[0].quarter == date(2023, 10, 1)
    assert got[0].year == date(2023, 1, 1) and got[0].week == date(2024, 1, 8)
    assert got[1].month == date(2024, 4, 1) and got[1].quarter == date(2024, 1, 1)


def test_flag_names():
    assert p.flag_names("x")[:3] == ["is_x_s", "is_x_s_1", "is_x_s_2"]
    assert len(p.flag_names("x")) == 10
