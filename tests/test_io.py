"""Sinks, text scans and the incremental stream."""

import uuid
from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import tables as k
from tidemark.sources import text as x
from tidemark.sources.workspace import fresh_folder
from tidemark.streaming import incremental
from tidemark.streaming.incremental import load_new_snapshots

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


@pytest.fixture
def table(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex[:10]}"
    yield name, str(tmp_path / name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_overwrite_is_idempotent_and_leaves_other_days(spark, rows, table):
    name, where = table
    first, second = rows("a int, b string", [(1, "x"), (2, "y")]), rows("a int, b string", [(3, "z")])
    k.write_partition(first, name, D1, location=where)
    k.write_partition(second, name, D2, location=where)
    before = bag(spark.table(name))
    k.write_partition(second, name, D2, location=where)
    assert bag(spark.table(name)) == before == [(1, "x", D1), (2, "y", D1), (3, "z", D2)]
    k.write_partition(rows("a int, b string", [(9, "n")]), name, "2024-01-01", location=where, even_files=True)
    assert bag(spark.table(name)) == [(3, "z", D2), (9, "n", D1)]


def test_columns_are_aligned_by_name(spark, rows, table):
    name, where = table
    k.write_partition(rows("a int, b string", [(1, "x")]), name, D1, location=where)
    k.write_partition(rows("B string, A int", [("y", 2)]), name, D2, location=where)
    assert bag(spark.table(name).select("a", "b")) == [(1, "x"), (2, "y")]


def test_schema_only_grows(spark, rows, table):
    name, where = table
    assert k.evolve_schema(rows("a int", [(1,)]), name) == []
    k.write_partition(rows("a int, b string", [(1, "x")]), name, D1, location=where)
    assert k.evolve_schema(rows("A int, c double, d date", [(1, 1.0, D1)]), name) == ["c", "d"]
    k.append_partition(rows("a int, c double", [(2, 1.5)]), name, D1, location=where)
    assert spark.table(name).columns == ["a", "b", "c", "d", "partitiondate"]
    assert bag(spark.table(name).select("a", "b", "c")) == sorted([(1, "x", None), (2, None, 1.5)], key=repr)


def test_append_adds(spark, rows, table):
    name, where = table
    for _ in range(2):
        k.append_partition(rows("a int", [(1,)]), name, D1, location=where)
    assert spark.table(name).count() == 2


def test_backfill_replaces_the_days_it_has(spark, rows, table):
    name, where = table
    frame = rows("a int, at string", [(1, "2024-01-01 08:00"), (2, "2024-01-02 09:00"), (3, "2024-01-02 10:00")])
    day = F.split("at", " ").getItem(0)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    k.backfill(frame, name, day, location=where)
    k.backfill(frame.where("a = 3"), name, day, location=where)
    assert bag(spark.table(name).select("a", "partitiondate")) == [(1, D1), (3, D2)]
    assert spark.conf.get(mode) == before


def test_append_parquet(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    frame = rows("a int, partitiondate date", [(1, D1), (2, D2)])
    k.append_parquet(frame, path)
    k.append_parquet(frame.where("a = 1"), path)
    assert spark.read.parquet(path).count() == 3
    k.append_parquet(frame.where("a = 1"), path, replace_dates=True)
    assert bag(spark.read.parquet(path)) == [(1, D1), (2, D2)]


def test_fixed_width(spark, rows, tmp_path):
    day = tmp_path / "2024-01-01"
    day.mkdir()
    text = "0001été  12\n0002     99\n0001été  12\n           \n"
    (day / "file_20240101_a.txt").write_bytes(text.encode("latin-1"))
    (day / "other_20240101_a.txt").write_bytes(b"zzzz")
    path = x.extract_glob(str(tmp_path), "file", "2024-01-01")
    layout = [("id", 1, 4), ("name", 5, 5), ("n", 10, 2)]
    got = bag(x.read_fixed_width(spark, path, layout, D1, encoding="ISO-8859-1"))
    assert got == sorted([("0001", "été", "12", D1), ("0002", None, "99", D1)], key=repr)


def test_delimited(rows):
    lines = rows("value string", [("a,b,c",), ("a, ,",), (",,",), ("a",)])
    got = bag(x.split_delimited(lines, ["p", "q"]))
    assert got == sorted([("a", "b"), ("a", None)], key=repr)
    dotted = rows("value string", [("1.2",)])
    assert bag(x.split_delimited(dotted, ["p", "q"], sep=".")) == [("1", "2")]


def test_stream_replaces_whole_days_however_often(spark, rows, table, tmp_path):
    name, where = table
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    schema = rows("a int, partitiondate date", [(1, D1)]).schema

    def deliver(*data):
        k.append_parquet(rows("a int, partitiondate date", list(data)), source)

    def load(where_to=checkpoint):
        load_new_snapshots(spark, source, schema, name, checkpoint=where_to, location=where, max_files=1)

    deliver((1, D1), (2, D1))
    load()
    # a late file of a day that is loaded already, and a new day
    deliver((3, D1), (4, D2))
    load()
    load()
    assert bag(spark.table(name)) == [(1, D1), (2, D1), (3, D1), (4, D2)]
    # starting over, as after a lost checkpoint, changes nothing
    load(str(tmp_path / "cp2"))
    assert bag(spark.table(name)) == [(1, D1), (2, D1), (3, D1), (4, D2)]


def test_stream_loads_rows_without_a_day_and_writes_each_day_once(spark, rows, table, tmp_path, monkeypatch):
    name, where = table
    source = str(tmp_path / "in")
    frame = rows("a int, partitiondate date", [(i, d) for i in range(4) for d in (D1, D2, None)])
    for i in range(4):  # four files of each day
        k.append_parquet(frame.where(F.col("a") == i), source)
    writes, backfill = [], incremental.backfill
    monkeypatch.setattr(incremental, "backfill", lambda *a, **o: (writes.append(a[0].count()), backfill(*a, **o)))
    load_new_snapshots(spark, source, frame.schema, name, checkpoint=str(tmp_path / "cp"), location=where, max_files=1)
    assert writes == [12]
    assert bag(spark.table(name)) == bag(frame)
    load_new_snapshots(spark, source, frame.schema, name, checkpoint=str(tmp_path / "cp"), location=where, max_files=1)
    assert writes == [12]


def test_stream_takes_up_days_that_a_failed_run_noted(spark, rows, table, tmp_path, monkeypatch):
    name, where = table
    source, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    frame = rows("a int, partitiondate date", [(1, D1)])
    k.append_parquet(frame, source)

    def fails(*_, **__):
        raise RuntimeError("lost")

    monkeypatch.setattr(incremental, "backfill", fails)
    with pytest.raises(RuntimeError):
        load_new_snapshots(spark, source, frame.schema, name, checkpoint=cp, location=where)
    monkeypatch.undo()
    load_new_snapshots(spark, source, frame.schema, name, checkpoint=cp, location=where)
    assert bag(spark.table(name)) == [(1, D1)]


def test_an_empty_result_leaves_the_day_without_rows(spark, rows, table):
    name, where = table
    frame = rows("a int", [(1,), (2,)])
    k.write_partition(frame, name, D1, location=where)
    k.write_partition(frame, name, D2, location=where)
    k.write_partition(frame.where("a > 5"), name, D1, location=where)
    assert bag(spark.table(name)) == [(1, D2), (2, D2)]


def test_folders_are_in_the_shared_one(spark):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError):
            fresh_folder(spark, "x")
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: "/shared/"))
    a, b = fresh_folder(session, "x"), fresh_folder(session, "x")
    assert a != b and a.startswith("/shared/x-")


def test_an_overwrite_leaves_the_session_alone(spark, tmp_path, monkeypatch):
    """The overwrite mode is set in no session but that of the insert."""
    mode = "spark.sql.sources.partitionOverwriteMode"
    seen, insert = [], type(spark).sql

    def sql(session, text, *args, **kwargs):
        if text.startswith("INSERT OVERWRITE"):
            seen.append((session is spark, spark.conf.get(mode), session.conf.get(mode)))
        return insert(session, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", sql)
    rows = spark.createDataFrame([(1, D1), (2, D1)], "id int, day date")
    k.backfill(rows, "kept_alone", F.col("day"), location=f"{tmp_path}/t")
    k.backfill(rows.where("id = 2"), "kept_alone", F.col("day"), location=f"{tmp_path}/t")
    before = spark.conf.get(mode)
    assert seen and all(x == (False, before, "dynamic") for x in seen if x[2] == "dynamic")
    assert [r["id"] for r in spark.table("kept_alone").collect()] == [2]
