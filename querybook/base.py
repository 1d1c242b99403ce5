"""Registration of queries and the tables they read."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The reference dates of the queries, inside the tables' ranges.
REF = "2001-06-15"
EVENT_REF = "2024-01-20"

# Codes of the queries on money: the wire kind of amounts, labels of loans and resources.
WIRE_KIND, CASH_KIND = "VIREMENT", "BILLET"
LABELS = ("EMPLOI", "RESSOURCE")

# Classes by the leading digits of a number, longer beginnings first.
LINE_CLASSES = {f"{n}": f"CLASS {n}" for n in (*range(10, 100, 3), *range(610, 620, 2))}


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="querybook-")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder for a query that writes.  A session of one machine that names no shared
    folder gets one of its own; on a cluster the setting is required."""
    master = spark.conf.get("spark.master", "")
    one_machine = master == "local" or master.startswith("local[")
    if one_machine and spark.conf.get(workspace.SETTING, None) is None:
        return workspace.unused(_own_folder(), name)
    return workspace.fresh_folder(spark, name)


class Tables:
    """The Parquet tables of one directory: ``Tables(spark, dir).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def presentable(df: DataFrame) -> DataFrame:
    """Plain types for the comparison: dates as text, decimals as doubles and
    booleans as 0/1."""

    def plain(f: T.StructField) -> Column:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            return column.cast("string").alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return column.cast("double").alias(f.name)
        if isinstance(f.dataType, T.BooleanType):
            return column.cast("int").alias(f.name)
        return column

    return df.select(*[plain(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` under a name, with its SQL."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presentable(fn(Tables(spark, sf_dir)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def cents(column: str | Column) -> Column:
    """A two-decimal amount held as a double, exactly."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("decimal(18,2)")


def literal_rows(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small table of constants, as a relation whose size Spark knows."""
    fields = [field.split() for field in schema.split(",")]
    names = ", ".join(name for name, _ in fields)
    casts = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in fields)
    return spark.sql(f"SELECT {casts} FROM {values_sql(rows)} AS t({names})")


def values_sql(rows: list[tuple]) -> str:
    """The same constants as a SQL VALUES list."""

    def text(v) -> str:
        if v is None:
            return "NULL"
        return f"'{v}'" if isinstance(v, str) else str(v)

    return "VALUES " + ", ".join("(" + ", ".join(text(v) for v in r) + ")" for r in rows)
