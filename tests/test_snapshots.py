from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tidemark.sources import snapshots as s


def d(text):
    return date.fromisoformat(text)


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    """A partitioned table with gaps: weekdays of 2022-2024, without August."""
    path = str(tmp_path_factory.mktemp("history") / "table")
    day = F.date_add(F.lit(d("2022-01-03")), F.col("id").cast("int"))
    table = spark.range(1000).select("id", day.alias("partitiondate")).where(
        "dayofweek(partitiondate) NOT IN (1, 7) AND month(partitiondate) <> 8"
    )
    table.write.partitionBy("partitiondate").parquet(path)
    return spark.read.parquet(path)


def dates_of(df, col="partitiondate"):
    return sorted(r[0] for r in df.select(col).distinct().collect())


def all_days():
    days = [d("2022-01-03") + timedelta(days=i) for i in range(1000)]
    return [x for x in days if x.weekday() < 5 and x.month != 8]


def test_single_snapshots(history):
    assert dates_of(s.snapshot_eq(history, "2024-03-15")) == [d("2024-03-15")]
    assert dates_of(s.snapshot_eq(history, "2024-03-16")) == []
    assert dates_of(s.snapshot_latest(history)) == [max(all_days())]
    assert dates_of(s.snapshot_asof(history, "2024-03-17")) == [d("2024-03-15")]
    assert dates_of(s.snapshot_asof(history, "2021-01-01")) == []


def test_ranges(history):
    days = all_days()
    assert dates_of(s.history_upto(history, "2022-02-01")) == [x for x in days if x <= d("2022-02-01")]
    assert dates_of(s.current_year_upto(history, "2023-01-05")) == [d(f"2023-01-0{i}") for i in (2, 3, 4, 5)]
    last = dates_of(s.last_n_days(history, "2024-03-15", 7))
    assert last == [d(f"2024-03-{i:02}") for i in (8, 11, 12, 13, 14, 15)]


def test_counts_snapshots_and_not_days(history):
    # the number counts the snapshots before the newest one
    assert dates_of(s.last_n_snapshots(history, "2024-03-17", 0)) == [d("2024-03-15")]
    assert dates_of(s.last_n_snapshots(history, "2024-03-17", 2)) == [d(f"2024-03-{i}") for i in (13, 14, 15)]


def test_period_snapshots(history):
    assert dates_of(s.period_snapshots(history, "2024-03-13", "week", 0)) == [d("2024-03-13")]
    assert dates_of(s.period_snapshots(history, "2024-03-13", "week", 1)) == [d("2024-03-08")]
    assert dates_of(s.period_snapshots(history, "2024-03-13", "month", 1)) == [d("2024-02-29")]
    assert dates_of(s.period_snapshots(history, "2023-09-30", "month", 1)) == []
    assert dates_of(s.period_snapshots(history, "2024-03-13", "quarter", 1)) == [d("2023-12-29")]
    assert dates_of(s.period_snapshots(history, "2024-02-29", "year", 1)) == [d("2023-12-29")]
    full = dates_of(s.period_snapshots(history, "2024-03-13", "week", 1, full=True))
    assert full == [d(f"2024-03-0{i}") for i in (4, 5, 6, 7, 8)]


def test_same_day_and_month_end(history):
    assert dates_of(s.same_day_years_ago(history, "2024-02-29", 1)) == [d("2023-02-28")]
    assert dates_of(s.month_end_snapshot(history, "2024-03-13", 3)) == [d("2023-12-29")]


def test_history_union(history):
    got = dates_of(
        s.history_from(history, "2024-03-13", days=1, weeks=1, months=1, quarters=1, years=1, year_to_year=1)
    )
    wanted = ["2023-03-13", "2023-12-29", "2024-02-29", "2024-03-08", "2024-03-12", "2024-03-13"]
    assert got == [d(x) for x in wanted]
    assert set(got) <= set(all_days())
    # zero switches a family on, None leaves it out
    assert dates_of(s.history_from(history, "2024-03-13", weeks=0)) == [d("2024-03-13")]
    assert dates_of(s.history_from(history, "2024-03-13")) == []


def test_history_full_periods(history):
    got = dates_of(s.history_from(history, "2024-03-13", months=1, full_period=True))
    assert got == [x for x in all_days() if d("2024-02-01") <= x <= d("2024-03-13")]


def test_presets(history):
    got = dates_of(s.comparison_calendar(history, "2024-03-13"))
    wanted = ["2022-12-30", "2023-03-13", "2023-11-30", "2023-12-29", "2024-01-31", "2024-02-29",
              "2024-03-07", "2024-03-08", "2024-03-11", "2024-03-12", "2024-03-13"]
    assert got == [d(x) for x in wanted]
    # a date that qualifies twice (month end and year end) is read once
    rows = s.comparison_calendar(history, "2024-03-13").groupBy("id").count().where("count > 1").count()
    assert rows == 0
    closes = dates_of(s.period_close_calendar(history, "2024-05-15"))
    assert closes == [d(x) for x in ("2023-12-29", "2024-02-29", "2024-04-30", "2024-05-10", "2024-05-15")]
    limited = dates_of(s.limited_history(history, "2024-03-05", n=2))
    assert limited == [d(x) for x in ("2023-12-29", "2024-02-29", "2024-03-04", "2024-03-05")]
    # the newest one not after the previous month's end may lie further back
    limited = dates_of(s.limited_history(history, "2023-09-04", n=1))
    assert limited == [d(x) for x in ("2022-12-30", "2023-07-31", "2023-09-04")]


def test_only_wanted_partitions_are_read(history):
    """The dates become partition filters on literals, so other days are not listed."""
    for df in (
        s.snapshot_asof(history, "2024-03-13"),
        s.history_from(history, "2024-03-13", days=2, months=2),
        s.comparison_calendar(history, "2024-03-13"),
        s.snapshot_eq(history, "2024-03-13"),
    ):
        plan = plan_of(df)
        filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
        assert "partitiondate" in filters and "2024-03-13" in filters
        assert "DataFilters: []" in plan
        assert "Filter (" not in plan and "Join" not in plan and "Exchange" not in plan


@pytest.fixture
def searched(monkeypatch):
    """The plans of all searches for dates."""
    plans, find = [], s._find

    def watched(dates, *args, **kwargs):
        seen = type(dates).agg

        def agg(frame, *columns):
            plans.append(plan_of(frame))
            return seen(frame, *columns)

        monkeypatch.setattr(type(dates), "agg", agg)
        try:
            return find(dates, *args, **kwargs)
        finally:
            monkeypatch.setattr(type(dates), "agg", seen)

    monkeypatch.setattr(s, "_find", watched)
    return plans


def bounds_of(plan):
    filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "partitiondate" in filters, plan
    return filters


def test_only_wanted_partitions_are_searched(history, searched):
    """The search for the dates itself opens only partitions that can hold one."""
    plans, day = searched, "2024-03-13"
    s.last_n_snapshots(history, day)
    for unit in ("week", "month", "quarter", "year"):
        s.period_snapshots(history, day, unit)
    s.period_snapshots(history, day, "week", week_rule="calendar_year")
    s.month_end_snapshot(history, day)
    s.history_from(history, day, days=2, weeks=1, months=2, year_to_year=1)
    s.comparison_calendar(history, day)
    s.period_close_calendar(history, day)
    s.limited_history(history, day)
    assert len(plans) == 11
    for plan in plans:
        assert "<= 20" in bounds_of(plan) and (">= 20" in bounds_of(plan) or "year(" in bounds_of(plan)), plan


def test_a_search_goes_back_in_bounded_ranges(history, searched):
    days = dates_of(history)
    for day, n in (("2024-03-13", 3), ("2031-05-05", 4), ("2024-03-13", len(days) + 5)):
        searched.clear()
        wanted = [x for x in days if x <= d(day)][-(n + 1) :]
        assert dates_of(s.last_n_snapshots(history, day, n)) == wanted
        assert len(searched) <= 8 and all(">=" in bounds_of(x) and "<=" in bounds_of(x) for x in searched)
    assert dates_of(s.snapshot_asof(history, "2031-05-05")) == [days[-1]]
    assert dates_of(s.snapshot_asof(history, "1999-01-01")) == []
    found = s.comparison_dates(s.snapshot_dates(history), "2031-05-05", days=2)
    assert (found["last_day"], found["last_2_days"]) == (days[-1], days[-2])


def test_filters_reach_the_scan_of_a_timestamp_column(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    picked = s.history_from(orders, "2001-06-15", days=2, col="o_orderdate").select("o_orderkey")
    plan = plan_of(picked)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_dates_from_the_catalog(spark, history, tmp_path):
    name = "dated"
    spark.sql(f"CREATE TABLE {name} (id bigint, partitiondate date) USING parquet PARTITIONED BY (partitiondate) LOCATION '{tmp_path}/t'")
    spark.sql(f"ALTER TABLE {name} ADD PARTITION (partitiondate = '2024-03-01') PARTITION (partitiondate = '2024-03-04')")
    known = s.catalog_dates(spark, name)
    assert dates_of(known) == [d("2024-03-01"), d("2024-03-04")]
    assert "FileScan" not in plan_of(known)
    asof = s.snapshot_asof(history, "2024-03-13", dates=known)
    assert dates_of(asof) == [d("2024-03-04")]


def test_incremental_delta(history, rows):
    target = rows("partitiondate date", [(d("2024-03-11"),), (d("2024-03-08"),), (d("2024-06-03"),)])
    # a target date after the reference date is no high-water mark
    got = dates_of(s.incremental_delta(history, target, "2024-03-14"))
    assert got == [d(f"2024-03-{i}") for i in (12, 13, 14)]
    everything = [x for x in all_days() if x <= d("2024-03-14")]
    assert dates_of(s.incremental_delta(history, None, "2024-03-14")) == everything
    assert dates_of(s.incremental_delta(history, target.where("false"), "2024-03-14")) == everything


def test_date_set_diff(rows):
    left = rows("partitiondate date", [(d("2024-01-01"),), (d("2024-01-01"),), (d("2024-01-02"),)])
    right = rows("partitiondate date", [(d("2024-01-02"),), (d("2024-01-03"),)])
    got = {tuple(r) for r in s.date_set_diff(left, right).collect()}
    assert got == {(d("2024-01-01"), "left"), (d("2024-01-03"), "right")}
