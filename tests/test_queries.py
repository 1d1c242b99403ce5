"""Every query against its SQL on the smallest tables, and properties of the plans."""

import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from querybook import ORACLES, QUERIES
from tests.conftest import plan_of
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
#: Queries for which the smallest tables have no rows.
LARGER, LARGER_DIR = ("shape_project_rename", "plan_portfolio_report"), "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    larger = name in LARGER
    given = (connect(LARGER_DIR), LARGER_DIR) if larger else (con, SF_DIR)
    problem, n = compare(spark, *given, QUERIES[name], ORACLES.get(name))
    assert problem == "" and n > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry_does_without_the_text_operators():
    """As when their subpackage is left out; any other missing module is an error."""
    root = Path(__file__).resolve().parent.parent
    code = "import sys; sys.modules['{}'] = None; import __spark_entry__ as e; print(len(e.queries()))"
    for missing, works in (("tidemark.llm", True), ("querybook.flows", False)):
        done = subprocess.run([sys.executable, "-c", code.format(missing)], cwd=root, capture_output=True, text=True)
        assert (done.returncode == 0) == works
        if works:
            assert int(done.stdout) == len(QUERIES)


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "variation_month_pct_amount" in df.columns


WRITERS = ("sink_", "stream_", "scan_fixed", "scan_delimited", "scan_csv")


def test_plans_hold_at_scale(spark):
    """No Python workers, no nested loops, nothing brought to one task but the set of
    a calendar's days, also when nothing is small enough to broadcast."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        for name, run in QUERIES.items():
            if name.startswith(WRITERS):
                continue
            plan = plan_of(run(spark, SF_DIR))
            for bad in ("Python", "NestedLoop", "Cartesian", "rangepartitioning"):
                assert bad not in plan, (name, bad)
            if name not in ("fill_expected_dates", "flow_monthly_balance_dense"):
                assert "SinglePartition" not in plan, name
    finally:
        spark.conf.set(setting, before)
