"""Refused lines and rollups from daily results."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.conftest import final_plan_of
from tidemark.functions import periods as p
from tidemark.operators import rollups as u
from tidemark.sources import checked as x

FIELDS = [x.Field("a", "int", True), x.Field("b"), x.Field("c", "date")]


def files(folder, named):
    folder.mkdir()
    for name, lines in named.items():
        (folder / name).write_bytes(b"\n".join(lines) + b"\n")
    return str(folder)


def test_every_line_is_in_one_output(spark, tmp_path):
    lines = {
        "one.txt": [b"1|x|2024-01-01", b"|x|2024-01-01", b"1|x", b"z| |2024-13-01|more", b"", b"7||", "2|é|".encode()],
        "two.txt": [b"3|\xff|", b"4|y|2024-02-29", b"4|y|2024-02-29"],
    }
    path = files(tmp_path / "in", lines)
    found = x.load_checked(x.judge_delimited(spark, path, FIELDS, "|"), str(tmp_path / "out"))
    rows = sorted((r["file"].rsplit("/", 1)[1], r["a"], r["b"], str(r["c"])) for r in found.rows.collect())
    assert rows == [
        ("one.txt", 1, "x", "2024-01-01"), ("one.txt", 2, "é", "None"), ("one.txt", 7, None, "None"),
        ("two.txt", 4, "y", "2024-02-29"), ("two.txt", 4, "y", "2024-02-29"),
    ]
    bad = sorted((r["file"].rsplit("/", 1)[1], tuple(r["reasons"])) for r in found.rejected.collect())
    assert bad == [
        ("one.txt", ("a: missing",)), ("one.txt", ("a: no int", "c: no date")), ("one.txt", ("short",)), ("one.txt", ("short",)),
        ("two.txt", ("undecodable",)),
    ]
    assert found.counts == {"lines": 10, "rows": 5, "rejected": 5}
    per_file = found.rows.select("file").unionByName(found.rejected.select("file")).groupBy("file").count().collect()
    assert {r["file"].rsplit("/", 1)[1]: r["count"] for r in per_file} == {k: len(v) for k, v in lines.items()}


def test_fixed_width_in_another_encoding(spark, tmp_path):
    path = files(tmp_path / "in", {"x": ["  1é2024-01-01".encode("latin-1"), b" 12ab", b"abcd2024-01-01"]})
    judged = x.judge_fixed_width(spark, path, [("a", 1, 3), ("b", 4, 1), ("c", 5, 10)], FIELDS, "ISO-8859-1")
    got = [(r["a"], r["b"], tuple(r["reasons"])) for r in judged.collect()]
    assert sorted(got, key=str) == sorted([(1, "é", ()), (12, "a", ("short",)), (None, "d", ("a: no int",))], key=str)


def test_empty_input(spark, tmp_path):
    found = x.load_checked(x.judge_delimited(spark, files(tmp_path / "in", {"x": []}), FIELDS).where("line <> ''"), str(tmp_path / "out"))
    assert found.counts == {"lines": 0, "rows": 0, "rejected": 0}


MEASURES = {
    "n": u.Measure(u.COUNT), "total": u.Measure(u.SUM, "v"), "low": u.Measure(u.MIN, "v"), "high": u.Measure(u.MAX, "v"),
    "kinds": u.Measure(u.DISTINCT, "kind"), "about": u.Measure(u.SKETCH, "v"),
}


def test_periods_from_days(spark, tmp_path):
    rng = random.Random(5)
    rows = [
        (rng.choice(["a", "b", None]), datetime(2023, 11, 20) + timedelta(hours=rng.randrange(24 * 120)), rng.choice([None, *range(30)]), rng.choice([None, *"xyz"]))
        for _ in range(800)
    ]
    df = spark.createDataFrame([*rows, ("a", None, 1, "x")], "k string, ts timestamp, v int, kind string")
    folder = str(tmp_path / "daily")
    u.write_days(df, "k", "ts", MEASURES, folder)
    daily = spark.read.parquet(folder)
    for unit in ("week", "month", "quarter", "year"):
        groups = defaultdict(list)
        for k, ts, v, kind in rows:
            groups[k, p.period_start(ts.date(), unit)].append((v, kind))
        expected = {}
        for key, group in groups.items():
            values = [v for v, _ in group if v is not None]
            sums = (sum(values), min(values), max(values)) if values else (None, None, None)
            expected[key] = (len(group), *sums, len({k for _, k in group} - {None}), len(set(values)))
        got = {(r["k"], r["period"]): tuple(r[c] for c in MEASURES) for r in u.merged_periods(daily, "k", unit, MEASURES).collect()}
        assert got == expected


def test_only_the_changed_day_is_read(spark, tmp_path):
    df = spark.range(300).selectExpr(
        "id % 3 AS k", "timestamp'2024-01-01 05:00:00' + make_dt_interval(id % 30) AS ts", "id AS v", "'x' AS kind", "date_add(date'2024-01-01', CAST(id % 30 AS INT)) AS d"
    )
    df.write.partitionBy("d").parquet(f"{tmp_path}/events")
    events = spark.read.parquet(f"{tmp_path}/events").withColumn("ts", F.col("d").cast("timestamp"))
    folder = str(tmp_path / "daily")
    u.write_days(events, "k", "ts", MEASURES, folder)
    changed = events.withColumn("v", F.col("v") + 1000)
    u.write_day(changed, "k", "ts", MEASURES, folder, "2024-01-07")
    daily = spark.read.parquet(folder)
    assert {str(r["day"]): r["high"] >= 1000 for r in daily.groupBy("day").agg(F.max("high").alias("high")).collect()} == {
        f"2024-01-{n:02d}": n == 7 for n in range(1, 31)
    }
    plan = final_plan_of(u.daily_partials(changed.where(p.day_of("ts") == p.date_lit("2024-01-07")), "k", "ts", MEASURES))
    assert "PartitionFilters: [" in plan and "2024-01-07" in plan.split("PartitionFilters: [")[1].split("]")[0]
