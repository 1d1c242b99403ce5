"""Writers for daily-partitioned tables.

All writers work on plain catalog tables (Parquet, ORC, ...) and on tables of any
catalog that supports dynamic partition overwrite by itself.  A table that is not
there yet is created empty from the schema, so the data is computed only once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import periods as p
from tidemark.functions.periods import DateLike
from tidemark.sources.snapshots import SNAPSHOT

FILE_FORMATS = ("parquet", "orc", "csv", "json", "text")


def _provider(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    found = rows.where(F.lower("col_name") == "provider").select("data_type").first()
    return found[0].lower() if found else ""


def _columns_ddl(df: DataFrame, names: list[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join(f"`{name}` {types[name]}" for name in names)


def missing_columns(df: DataFrame, table: str) -> list[str]:
    """Columns of ``df`` that the table lacks; names compare case-insensitively."""
    have = {c.lower() for c in df.sparkSession.table(table).columns}
    return [c for c in df.columns if c.lower() not in have]


def evolve_schema(df: DataFrame, table: str) -> list[str]:
    """Add the columns of ``df`` that the table lacks and return their names.

    Purely additive: nothing is dropped and no type changes.  A table that does
    not exist is left alone.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return []
    new = missing_columns(df, table)
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns_ddl(df, new)})")
    return new


def _prepare(
    df: DataFrame, table: str, col: str, provider: str, location: str | None
) -> None:
    """Create the table empty if it is absent, else add the new columns."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        evolve_schema(df, table)
        return
    where = f" LOCATION '{location}'" if location else ""
    names = [c for c in df.columns if c.lower() != col.lower()] + [col]
    spark.sql(
        f"CREATE TABLE {table} ({_columns_ddl(df, names)}) USING {provider}"
        f" PARTITIONED BY ({col}){where}"
    )


def _aligned(df: DataFrame, table: str) -> DataFrame:
    """``df`` in the table's column order, absent columns as typed nulls."""
    given = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            F.col(given[f.name.lower()]).cast(f.dataType).alias(f.name)
            if f.name.lower() in given
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in df.sparkSession.table(table).schema.fields
        ]
    )


def _insert(df: DataFrame, table: str, overwrite: bool) -> None:
    """Append, or replace the partitions that receive rows.

    An insert into a file table takes the overwrite mode from the session only, so an
    overwrite runs in a session of its own, and no other query of the caller's sees another
    setting.
    """
    spark = df.sparkSession
    rows = _aligned(df, table)
    if _provider(spark, table) not in FILE_FORMATS:
        rows.writeTo(table).overwritePartitions() if overwrite else rows.writeTo(table).append()
        return
    if not overwrite:
        rows.write.insertInto(table)
        return
    own, view = _session_like(spark), f"rows_{uuid.uuid4().hex}"
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    rows.createGlobalTempView(view)
    try:
        own.sql(f"INSERT OVERWRITE TABLE {table} SELECT * FROM {spark.conf.get(_GLOBAL_VIEWS)}.{view}")
    finally:
        spark.catalog.dropGlobalTempView(view)
    spark.catalog.refreshTable(table)


_GLOBAL_VIEWS = "spark.sql.globalTempDatabase"


def _session_like(spark: SparkSession) -> SparkSession:
    """A new session with the caller's settings and database."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return own


def _replace_day(df: DataFrame, table: str, col: str, day: DateLike) -> None:
    """Replace one known partition, also by nothing."""
    spark = df.sparkSession
    if _provider(spark, table) not in FILE_FORMATS:
        _aligned(df, table).writeTo(table).overwrite(F.col(col) == p.date_lit(day))
        return
    rows = _aligned(df, table).drop(col)
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({col} = '{p.as_date(day)}') SELECT * FROM {{rows}}",
        rows=rows,
    )


def _even(df: DataFrame, wanted: bool) -> DataFrame:
    return df.hint("rebalance") if wanted else df


def write_partition(
    df: DataFrame,
    table: str,
    date: DateLike,
    col: str = SNAPSHOT,
    provider: str = "parquet",
    location: str | None = None,
    even_files: bool = False,
) -> None:
    """Replace the partition of one day; running it again changes nothing else.  An
    empty result leaves the day without rows.

    ``even_files`` adds an exchange that merges small and splits large tasks, for a
    result that comes in many small pieces.
    """
    stamped = _even(df, even_files).withColumn(col, p.date_lit(date))
    _prepare(stamped, table, col, provider, location)
    _replace_day(stamped, table, col, date)


def append_partition(
    df: DataFrame,
    table: str,
    date: DateLike,
    col: str = SNAPSHOT,
    provider: str = "parquet",
    location: str | None = None,
    even_files: bool = False,
) -> None:
    """Add rows to the partition of one day, so several producers can fill it."""
    stamped = _even(df, even_files).withColumn(col, p.date_lit(date))
    _prepare(stamped, table, col, provider, location)
    _insert(stamped, table, overwrite=False)


def backfill(
    df: DataFrame,
    table: str,
    date_of_row: Column,
    col: str = SNAPSHOT,
    provider: str = "parquet",
    location: str | None = None,
) -> None:
    """Write many days at once: each row goes to the partition of its own date and
    every partition that receives rows is replaced.

    Rows are brought together by date and sorted inside a task, so a task keeps
    one file open at a time.  The exchange is a *rebalance*: a day that holds a
    large share of the rows is split over several tasks, small days share one.
    """
    stamped = df.withColumn(col, date_of_row.cast("date"))
    _prepare(stamped, table, col, provider, location)
    gathered = stamped.hint("rebalance", col).sortWithinPartitions(col)
    _insert(gathered, table, overwrite=True)


def append_parquet(
    df: DataFrame, path: str, col: str = SNAPSHOT, replace_dates: bool = False
) -> None:
    """Append to a partitioned Parquet directory.

    A repeated append duplicates rows; ``replace_dates`` replaces the partitions
    that ``df`` touches instead, which makes a re-run harmless.
    """
    writer = df.write.partitionBy(col).option("compression", "snappy")
    if replace_dates:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode("append").parquet(path)
