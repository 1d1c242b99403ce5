"""Compare queries with their SQL: ``python -m tests.oracle [dir] [name ...]``.

Values must be equal as a multiset of rows; doubles are compared exactly.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DEFAULT_DIR = "/root/testdata/sf0.01"


def spark_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "20000")
        .config("spark.sql.debug.maxToStringFields", "1000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    return v


def _bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, con, sf_dir: str, run, sql: str | None) -> tuple[str, int]:
    """('' or a message, row count)."""
    df = run(spark, sf_dir)
    rows = df.collect()
    if sql is None:
        return "", len(rows)
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    types = {c[0]: str(c[1]) for c in cursor.description}
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}", len(rows)
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
    for name, kind in df.dtypes:
        if kinds.get(types[name]) != kind:
            return f"type of {name}: {kind} / {types[name]}", len(rows)
    ours, theirs = _bag(rows, df.columns), _bag(expected, names)
    if ours == theirs:
        return "", len(rows)
    only_ours, only_theirs = ours - theirs, theirs - ours
    return (
        f"{sum(only_ours.values())} of {len(rows)} / {sum(only_theirs.values())} of"
        f" {len(expected)} rows differ {sorted(names)}\n   ours   "
        f"{sorted(map(str, only_ours))[:3]}\n   theirs {sorted(map(str, only_theirs))[:3]}",
        len(rows),
    )


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    sf_dir = argv.pop(0) if argv and argv[0].startswith("/") else DEFAULT_DIR
    spark, con = spark_session(), connect(sf_dir)
    oracle, failed, empty = oracle_sql(), [], []
    for name, run in queries().items():
        if argv and not any(name.startswith(a) for a in argv):
            continue
        began = time.time()
        try:
            problem, n = compare(spark, con, sf_dir, run, oracle.get(name))
        except Exception as e:  # report and go on
            problem, n = f"{type(e).__name__}: {str(e)[:900]}", -1
        checked = "sql" if name in oracle else "rows only"
        print(f"{'ok  ' if not problem else 'FAIL'} {name:36s} {n:7d} {time.time() - began:5.1f}s {checked} {problem}", flush=True)
        if problem:
            failed.append(name)
        if n == 0:
            empty.append(name)
    print("failed:", failed, "empty:", empty)
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
