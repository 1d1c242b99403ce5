"""Sinks and text scans: what has been written is read back.

Each query writes to a folder of its own in the session's shared folder, so that
queries can run side by side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querybook.base import REF, Tables, fresh_folder, query
from tidemark.sinks import tables as k
from tidemark.sources import snapshots
from tidemark.sources import text as x
from tidemark.streaming.incremental import load_new_snapshots

DAY = "CAST(CAST(date_trunc('year', o_orderdate) AS DATE) AS VARCHAR)"


def _table(t: Tables, name: str) -> tuple[str, str]:
    """A new table name and its location."""
    folder = fresh_folder(t.spark, name)
    return folder.rsplit("/", 1)[1].replace("-", "_"), folder


def _orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


def _year(column: str = "o_orderdate"):
    return F.trunc(F.col(column).cast("date"), "year")


@query(
    "sink_backfill",
    f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {DAY} AS partitiondate FROM orders",
)
def sink_backfill(t: Tables) -> DataFrame:
    """Every order goes to the partition of its year; a second run changes nothing."""
    name, folder = _table(t, "backfill")
    for _ in range(2):
        k.backfill(_orders(t), name, _year(), location=folder)
    return t.spark.table(name).drop("o_orderdate")


@query(
    "sink_overwrite_partition",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {DAY} AS partitiondate FROM orders
WHERE year(o_orderdate) <> 1999
UNION ALL SELECT o_orderkey, o_custkey, 'X', o_totalprice * 2, '1999-01-01' FROM orders
WHERE year(o_orderdate) = 1999 AND o_orderstatus <> 'P'""",
)
def sink_overwrite_partition(t: Tables) -> DataFrame:
    """One partition is replaced, twice, and the others stay."""
    name, folder = _table(t, "overwrite")
    k.backfill(_orders(t), name, _year(), location=folder)
    changed = _orders(t).where("year(o_orderdate) = 1999 AND o_orderstatus <> 'P'").withColumns(
        {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") * 2}
    )
    for _ in range(2):
        k.write_partition(changed, name, "1999-01-01", location=folder)
    return t.spark.table(name).drop("o_orderdate")


@query(
    "sink_append_partition",
    "SELECT o_orderkey, o_orderstatus, '2001-08-01' AS partitiondate FROM orders",
)
def sink_append_partition(t: Tables) -> DataFrame:
    """Three producers fill one date."""
    name, folder = _table(t, "append")
    for status in ("F", "O", "P"):
        part = t.orders.where(F.col("o_orderstatus") == status).select("o_orderkey", "o_orderstatus")
        k.append_partition(part, name, "2001-08-01", location=folder)
    return t.spark.table(name)


@query(
    "sink_evolve_schema",
    """SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS priority, '2001-01-01' AS partitiondate FROM orders
UNION ALL SELECT o_orderkey, CAST(NULL AS BIGINT), o_orderpriority, '2001-02-01' FROM orders""",
)
def sink_evolve_schema(t: Tables) -> DataFrame:
    """The second day has a column more and one less; its name differs in case."""
    name, folder = _table(t, "evolve")
    k.write_partition(t.orders.select("o_orderkey", "o_custkey"), name, "2001-01-01", location=folder)
    second = t.orders.select(F.col("o_orderkey").alias("O_ORDERKEY"), F.col("o_orderpriority").alias("priority"))
    k.write_partition(second, name, "2001-02-01", location=folder)
    return t.spark.table(name)


@query(
    "sink_append_parquet",
    f"""SELECT o_orderkey, o_totalprice, {DAY} AS partitiondate FROM orders
UNION ALL SELECT o_orderkey, o_totalprice, {DAY} FROM orders WHERE year(o_orderdate) < 1998""",
)
def sink_append_parquet(t: Tables) -> DataFrame:
    """An append that is repeated for some days, then replaced for others."""
    folder = fresh_folder(t.spark, "parquet")
    rows = t.orders.select("o_orderkey", "o_totalprice", _year().alias("partitiondate"))
    old = rows.where("year(partitiondate) < 1998")
    k.append_parquet(rows, folder)
    k.append_parquet(old, folder)
    k.append_parquet(rows.where("year(partitiondate) >= 1998"), folder, replace_dates=True)
    return t.spark.read.parquet(folder)


@query(
    "sink_catalog_asof",
    f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {DAY} AS partitiondate FROM orders WHERE {DAY} = '2001-01-01'",
)
def sink_catalog_asof(t: Tables) -> DataFrame:
    """The newest snapshot of a catalog table, whose dates come from the metadata alone."""
    name, folder = _table(t, "dated")
    k.backfill(_orders(t), name, _year(), location=folder)
    dates = snapshots.catalog_dates(t.spark, name)
    return snapshots.snapshot_asof(t.spark.table(name), REF, dates=dates).drop("o_orderdate")


@query(
    "stream_incremental_load",
    f"SELECT o_orderkey, o_totalprice, {DAY} AS partitiondate FROM orders",
)
def stream_incremental_load(t: Tables) -> DataFrame:
    """Files that arrive in two deliveries are loaded by two runs of the stream."""
    source, checkpoint = fresh_folder(t.spark, "source"), fresh_folder(t.spark, "checkpoint")
    name, folder = _table(t, "loaded")
    rows = t.orders.select("o_orderkey", "o_totalprice", _year().alias("partitiondate"))
    for delivery in (F.col("o_totalprice") < 250000, F.col("o_totalprice") >= 250000):
        k.append_parquet(rows.where(delivery), source)
        load_new_snapshots(t.spark, source, rows.schema, name, checkpoint=checkpoint, location=folder)
    return t.spark.table(name)


LAYOUT = [("number", 1, 12), ("customer", 13, 10), ("priority", 23, 16), ("amount", 39, 14), ("note", 53, 4)]


@query(
    "scan_fixed_width",
    """SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS number, CAST(o_custkey AS VARCHAR) AS customer,
  o_orderpriority AS priority, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount,
  CASE WHEN o_orderstatus = 'P' THEN 'été' END AS note, '2001-08-01' AS partitiondate FROM orders""",
)
def scan_fixed_width(t: Tables) -> DataFrame:
    """Orders as fixed-width lines with an accent, in Latin-1, with blank lines."""
    fields = [
        F.lpad(F.col("o_orderkey").cast("string"), 12, " "),
        F.rpad(F.col("o_custkey").cast("string"), 10, " "),
        F.rpad("o_orderpriority", 16, " "),
        F.lpad(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), 14, " "),
        F.rpad(F.when(F.col("o_orderstatus") == "P", "été").otherwise(""), 4, " "),
    ]
    line = F.concat(*fields)
    blank = F.lpad(F.lit(""), 56, " ")
    lines = t.orders.select(F.explode(F.array(line, blank)).alias("value"))
    folder = fresh_folder(t.spark, "fixed")
    path = f"{folder}/2001-08-01/orders_20010801_0"
    lines.write.option("encoding", "ISO-8859-1").option("header", False).option("sep", "\u0001").option(
        "quote", ""
    ).option("ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False).csv(path)
    return x.read_fixed_width(t.spark, path, LAYOUT, "2001-08-01", encoding="ISO-8859-1")


@query(
    "scan_delimited",
    """SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS number, NULLIF(CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END, '') AS flag,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS amount, CAST(NULL AS VARCHAR) AS absent FROM lineitem""",
)
def scan_delimited(t: Tables) -> DataFrame:
    """Line items as delimited text; the last field is never there."""
    flag = F.when(F.col("l_returnflag") == "N", " ").otherwise(F.col("l_returnflag"))
    line = F.concat_ws(
        "|", F.col("l_orderkey").cast("string"), flag,
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
    )
    folder = fresh_folder(t.spark, "delimited")
    t.lineitem.select(line.alias("value")).write.text(folder)
    return x.read_delimited(t.spark, folder, ["number", "flag", "amount", "absent"], sep="|")


@query(
    "scan_csv",
    "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders",
)
def scan_csv(t: Tables) -> DataFrame:
    folder = fresh_folder(t.spark, "csv")
    kept = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    kept.write.option("header", True).option("sep", ";").csv(folder)
    schema = "o_orderkey bigint, o_orderpriority string, o_totalprice double"
    return x.read_csv_with_header(t.spark, folder, schema, sep=";")
