"""How plans deal their rows: what an exchange carries and how finely tasks are cut."""

import re

import pytest
from pyspark.sql import functions as F

from querybook import QUERIES
from tidemark.operators import comparison as c
from tidemark.operators import segments as g
from tidemark.operators import shaping
from tidemark.plans.dimensions import contract_graph


def plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


@pytest.fixture
def history(spark):
    rows = [(k, i, i) for k in (1, 2, None) for i in range(50)]
    return spark.createDataFrame(rows, "k int, n int, v int").select("k", F.expr("date_add(DATE'2023-01-01', n)").alias("d"), "v")


def test_rows_in_segments_stay_where_the_windows_left_them(history, capsys):
    cut = c.propagate_balances(history, "v", "2023-02-10", "k", "d", observed=["quarter"], hot_rows=5)
    text = plan(cut, capsys)
    assert "__place" in text
    assert not re.search(r"hashpartitioning\(coalesce\(k[^\n]*__segment", text)
    # The windows' inputs, some dozens of columns, are worked out after the exchange of the rows.
    assert "REPARTITION_BY_COL" in text


def test_no_task_reads_a_whole_key_for_its_bounds(history, capsys):
    text = plan(g.with_segments(history, "k", "d", hot_rows=5, segments=4), capsys)
    assert "partial_percentile_approx" in text and "LeftSemi" not in text


def test_nearest_known_deals_the_stream_by_number(history, capsys):
    text = plan(g.nearest_known(history, history.where("v % 3 = 0").withColumnRenamed("v", "w"), "k", "d", ["w"], hot_rows=5), capsys)
    assert re.search(r"hashpartitioning\(__place[^\n]*REPARTITION_BY_NUM", text)


@pytest.mark.parametrize("name", ["plan_overdraft_flags", "plan_activity_score"])
def test_wide_groups_are_dealt_by_number(spark, name, tmp_path, capsys):
    stamp = "TIMESTAMP'2001-06-15'"
    spark.sql(f"SELECT 1L o_orderkey, 2L o_custkey, 'O' o_orderstatus, 5D o_totalprice, {stamp} o_orderdate, '1-URGENT' o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql(f"SELECT 1L l_orderkey, {stamp} l_shipdate, 'A' l_returnflag, 1 l_linenumber").write.parquet(f"{tmp_path}/lineitem.parquet")
    out = QUERIES[name](spark, str(tmp_path))
    text = plan(out, capsys)
    assert len(re.findall("REPARTITION_BY_NUM", text)) >= 2 and out.count() == 1


def test_links_to_elements_that_lead_nowhere_are_left_before_the_join(spark, capsys):
    def made(rows, schema):
        return spark.createDataFrame(rows, schema)

    ended, valid = "1999-01-01", "2030-01-01"
    accounts = made([(1, 10), (1, 11), (2, 11), (None, 10)], "account int, element int")
    links = made([(10, 11), (10, 12), (10, 13), (11, 14), (11, None)], "element int, linked int")
    elements = made([(10, 1, "p"), (11, 1, "p"), (12, 1, "q"), (13, 2, "p"), (14, 3, "p")], "element int, contract int, product string")
    contracts = made([(1, "a"), (2, "b"), (3, "a")], "contract int, contract_type string")
    holders = made([(1, 7, True)], "contract int, holder int, main boolean")
    types = made([("a", valid), ("b", ended)], "contract_type string, day string").selectExpr("contract_type", "date(day) AS dfval")
    products = made([("p", valid), ("q", ended)], "product string, day string").selectExpr("product", "date(day) AS dfval")
    out = contract_graph(accounts, links, elements, contracts, holders, types, products, "2000-01-01")
    found = {(r.account, r.element, r.contract, r.product, r.contract_type, r.holder) for r in out.collect()}
    rest = {10: (1, "p", "a", 7), 11: (1, "p", "a", 7), 14: (3, "p", "a", None)}
    assert found == {(a, e, *rest[e]) for a, e in [(1, 10), (1, 11), (1, 14), (2, 11), (2, 14), (None, 10), (None, 11)]}
    assert out.count() == len(found)
    assert len(re.findall("REPARTITION_BY_NUM", plan(out, capsys))) >= 2


def test_product_of_a_key_is_written_small(spark, tmp_path):
    """Rows met by the same many rows repeat them at short distance, whatever order they come in."""
    left = spark.range(80).select("id", (F.col("id") % 4).alias("j"))
    second = spark.range(24_000).select((F.col("id") % 4).alias("j"), F.repeat(F.md5(F.col("id").cast("string")), F.lit(2)).alias("v"))
    none = second.where("false").withColumnRenamed("j", "k")
    out = shaping.enrich_with_fallback(left, none, second, {"id": "k"}, {"j": "j"}, ["v"])
    out.write.parquet(f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 80 * 6_000
    assert sum(p.stat().st_size for p in (tmp_path / "out").glob("*.parquet")) < 5e6


def test_a_key_is_matched_in_shares(spark, monkeypatch, capsys):
    monkeypatch.setattr(shaping, "SECOND_SHARE", 2)
    monkeypatch.setattr(shaping, "LEFT_SHARE", 2)
    left = [(i, i % 3 or None, i % 2) for i in range(20)] + [(3, 0, 1), (3, 0, 1), (21, 9, 9), (None, 1, 1), (None, 1, 1)]
    first = [(3, "a"), (3, None), (5, "b"), (None, "c")]
    second = [(i % 3 or None, i % 2, f"v{i}") for i in range(24)] + [(1, 1, "v1"), (1, 1, None)]
    frame = spark.createDataFrame(left, "k int, j int, l int")
    out = shaping.enrich_with_fallback(
        frame,
        spark.createDataFrame(first, "k int, v string"),
        spark.createDataFrame(second, "j int, l int, v string"),
        {"k": "k"}, {"j": "j", "l": "l"}, ["v"],
    )
    want = []
    for k, j, l in left:
        known = [v for f, v in first if k is not None and f == k]
        other = [v for x, y, v in second if j is not None and (x, y) == (j, l)]
        want += [(k, j, l, v, 1) for v in known] or [(k, j, l, v, 2) for v in other] or [(k, j, l, None, None)]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    assert re.search(r"hashpartitioning\(j[^\n]*__share[^\n]*REPARTITION_BY_NUM", plan(out, capsys))


def test_texts_that_equal_one_number_meet_its_rows_once(spark):
    frame = spark.createDataFrame([(1, "1"), (2, "01"), (3, "x2")], "k int, j string")
    second = spark.createDataFrame([(1, "a"), (1, "b")], "j int, v string")
    none = second.where("false").withColumnRenamed("j", "k")
    with_numbers = frame.withColumn("j", F.expr("try_cast(j AS double)"))
    for df in (frame.where("k < 3"), with_numbers):
        out = shaping.enrich_with_fallback(df, none, second, {"k": "k"}, {"j": "j"}, ["v"]).where("v is not null")
        assert sorted((r.k, r.v) for r in out.collect()) == [(1, "a"), (1, "b"), (2, "a"), (2, "b")]
