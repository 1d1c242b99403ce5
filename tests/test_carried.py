"""Carried states against the history."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tests.test_comparison import random_history
from tidemark.operators import carried as k
from tidemark.operators import comparison as c

PERIODS = [("month", 1), ("month", 2), ("week", 1), ("year", 1)]
WHAT = k.Carried.of("v", "k", "d", days=(1, 2, 3), periods=PERIODS, observed=["quarter"])


def bag(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def rows():
    found = [r for r in random_history(17, keys=9) if r[1] <= date(2024, 1, 20)]
    return found + [(None, date(2024, 1, 1) + timedelta(days=3 * i), i) for i in range(6)]


@pytest.fixture
def history(spark, rows):
    return spark.createDataFrame(rows, "k int, d date, v int")


def as_of(history, day):
    return c.propagate_as_of(history, "v", day, "k", "d", days=(1, 2, 3), periods=PERIODS, observed=["quarter"])


def test_states_day_by_day_and_after_a_change(spark, rows, history, tmp_path):
    folder = str(tmp_path)
    days = [date(2023, 12, 28) + timedelta(days=i) for i in range(8)]
    k.carry_forward(history, WHAT, folder, days)
    for day in (days[3], days[5], days[7]):
        before = k.state_on(spark, folder, day - timedelta(days=1))
        got = k.report(history, before, WHAT, day, same_day=history)
        expected = as_of(history, day)
        assert set(got.columns) == set(expected.columns)
        assert bag(got.select(expected.columns)) == bag(expected)
    for day in (days[0], days[7]):
        assert normal(k.state_on(spark, folder, day)) == normal(k.state_of(history, WHAT, day))

    changed = [(key, d, 7000 if d == days[4] and v is not None else v) for key, d, v in rows]
    changed += [(77, days[4], 5), (3, days[4], 6)] if not any(r[0] == 3 and r[1] == days[4] for r in rows) else [(77, days[4], 5)]
    new = spark.createDataFrame(changed, "k int, d date, v int")
    k.carry_forward(new, WHAT, folder, days, first=days[4], known=days[3])
    assert normal(k.state_on(spark, folder, days[7])) == normal(k.state_of(new, WHAT, days[7]))
    after = days[7] + timedelta(days=1)
    got = k.report(new, k.state_on(spark, folder, days[7]), WHAT, after, same_day=new)
    assert bag(got.select(as_of(new, after).columns)) == bag(as_of(new, after))


def normal(state):
    """States with their closes in order, without periods that no later day asks for."""
    lists = F.array_sort(F.transform("closes", lambda x: F.struct(x["unit"], x["start"], x["now"])))
    return bag(state.withColumn("closes", lists))


def test_a_report_reads_a_state_and_a_day(spark, history, tmp_path):
    history.write.partitionBy("d").parquet(f"{tmp_path}/source")
    source = spark.read.parquet(f"{tmp_path}/source")
    day = date(2024, 1, 4)
    k.carry_forward(source, WHAT, f"{tmp_path}/states", [day - timedelta(days=2), day - timedelta(days=1)])
    out = k.report(source, k.state_on(spark, f"{tmp_path}/states", day - timedelta(days=1)), WHAT, day)
    files = out.inputFiles()
    assert {f.split("/")[-2] for f in files if "/states/" in f} == {f"day={day - timedelta(days=1)}"}
    scan = plan_of(out)
    assert scan.count("FileScan") == 2 and f"(d#" in scan and "2024-01-04" in scan.split("PartitionFilters")[1]
    expected = as_of(history, day).drop("same_day_last_year_v")
    assert bag(out.select(expected.columns)) == bag(expected)
