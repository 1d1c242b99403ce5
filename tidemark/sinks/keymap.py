"""A persistent map from natural keys to dense numbers.

Hashed keys meet sooner or later.  Here every natural key gets a number of its own the
first time it is seen and keeps it in all later loads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import as_list, attach


def read_keys(spark: SparkSession, folder: str) -> DataFrame | None:
    """The map so far, or none."""
    try:
        return spark.read.parquet(folder)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def add_keys(df: DataFrame, natural: str | Sequence[str], folder: str, name: str = "id", buckets: int = 256) -> DataFrame:
    """Adds the natural keys of ``df`` that the map in ``folder`` does not have, and returns
    the map: the natural columns and ``name``, numbers from 1 without gaps.

    New keys are numbered inside ``buckets`` of their hash in order, behind those of the
    buckets before, so no task numbers all of them; only a count per bucket reaches the
    driver.  A load is one appended write, and a load that fails adds nothing.  One load at
    a time may write a map.  Null parts are values.
    """
    spark, natural = df.sparkSession, as_list(natural)
    old = read_keys(spark, folder)
    new = df.select(*natural).distinct()
    highest = 0
    if old is not None:
        new = attach(new, old.select(*natural), natural, "left_anti")
        highest = old.agg(F.max(name)).first()[0] or 0
    new = new.withColumn("__bucket", F.pmod(F.xxhash64(*natural), F.lit(buckets)).cast("int"))
    counts = {r["__bucket"]: r["count"] for r in new.groupBy("__bucket").count().collect()}
    if counts:
        before = [highest]
        for b in range(buckets):
            before.append(before[-1] + counts.get(b, 0))
        start = F.element_at(F.array(*[F.lit(x).cast("long") for x in before[:-1]]), F.col("__bucket") + 1)
        own = Window.partitionBy("__bucket").orderBy(*natural)
        numbered = new.select(*natural, (start + F.row_number().over(own)).alias(name))
        numbered.write.mode("append").parquet(folder)
    found = read_keys(spark, folder)
    return new.select(*natural, F.lit(0).cast("long").alias(name)) if found is None else found


def with_keys(df: DataFrame, keys: DataFrame, natural: str | Sequence[str], name: str = "id") -> DataFrame:
    """``df`` with the number of each row's natural key."""
    return attach(df, keys.select(*as_list(natural), name), as_list(natural))
