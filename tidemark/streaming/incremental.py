"""The incremental snapshot load as a Structured Streaming job.

The batch form is ``sources.snapshots.incremental_delta``: it compares the newest
dates of two tables.  Here the stream's own checkpoint remembers which files have
been loaded, so a run also finds files that arrive late for an old day.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import periods as p
from tidemark.sinks.tables import backfill
from tidemark.sources.snapshots import SNAPSHOT
from tidemark.sources.workspace import shared_folder


def load_new_snapshots(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    table: str,
    col: str = SNAPSHOT,
    checkpoint: str | None = None,
    location: str | None = None,
    max_files: int | None = None,
) -> None:
    """Load everything new in a partitioned Parquet directory, then stop.

    A micro-batch may hold only some files of a day, and may be repeated after a
    failure.  So batches only note, in a small table beside the checkpoint, which days
    have changed.  When all files are seen, the noted days are read whole from the source
    and replaced in the table, each once, however many batches touched it.  Days noted by
    a run that failed before replacing them are taken up by the next.  Rows without a day
    are a partition of their own.
    """
    checkpoint = (checkpoint or f"{shared_folder(spark).rstrip('/')}/loads/{table}").rstrip("/")
    noted, replaced = f"{checkpoint}-days", f"{checkpoint}-replaced"
    files = spark.readStream.schema(schema)
    if max_files:
        files = files.option("maxFilesPerTrigger", max_files)

    def note_days(batch: DataFrame, number: int) -> None:
        days = batch.select(p.day_of(col).alias("day")).distinct()
        days.coalesce(1).write.mode("overwrite").parquet(f"{noted}/batch={number}")

    query = (
        files.parquet(source)
        .writeStream.foreachBatch(note_days)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    _replace_noted(spark, source, schema, table, col, location, noted, replaced)
    # the batches ran in a session of their own; drop what this one remembers
    if spark.catalog.tableExists(table):
        spark.catalog.refreshTable(table)


def _replace_noted(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    table: str,
    col: str,
    location: str | None,
    noted: str,
    replaced: str,
) -> None:
    """Replace the days noted by batches that no earlier run has replaced."""
    notes = _read(spark, noted, "day date, batch long")
    last = _read(spark, replaced, "batch long").agg(F.max("batch")).first()[0]
    open_notes = notes if last is None else notes.where(F.col("batch") > last)
    # one row per calendar day and batch at most
    found = open_notes.agg(F.collect_set("day"), F.max("batch"), F.bool_or(F.isnull("day"))).first()
    if found[1] is None:
        return
    day = p.day_of(col)
    wanted = day.isin([F.lit(d) for d in found[0]]) if found[0] else F.lit(False)
    if found[2]:
        wanted = wanted | day.isNull()
    rows = spark.read.schema(schema).parquet(source).where(wanted)
    backfill(rows, table, F.col(col), col, location=location)
    spark.range(1).select(F.lit(found[1]).cast("long").alias("batch")).write.mode("append").parquet(replaced)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet directory, or no rows if there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
