"""Text extracts: fixed-width and delimited lines."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import periods as p
from tidemark.functions.periods import DateLike
from tidemark.sources.snapshots import SNAPSHOT


class Slice(NamedTuple):
    """One field of a fixed-width line; ``start`` counts from 1."""

    name: str
    start: int
    length: int


def extract_glob(path: str, name: str, date: DateLike) -> str:
    """Files of one extract and day: ``path/<date>/<name>_<yyyymmdd>_*.txt``."""
    day = p.as_date(date)
    return f"{path}/{day.isoformat()}/{name}_{day:%Y%m%d}_*.txt"


def read_lines(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """Text lines as one ``value`` column, decoded from ``encoding``."""
    lines = spark.read.text(path)
    if encoding.lower().replace("_", "-") in ("utf-8", "utf8"):
        return lines
    return lines.select(F.decode(F.col("value").cast("binary"), encoding).alias("value"))


def _blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def _clean(rows: DataFrame, date: DateLike | None, col: str) -> DataFrame:
    """Drop empty rows, de-duplicate and stamp the load date."""
    rows = rows.dropna("all").distinct()
    return rows if date is None else rows.withColumn(col, p.date_lit(date))


def split_fixed_width(
    lines: DataFrame,
    layout: Sequence[Slice | tuple[str, int, int]],
    date: DateLike | None = None,
    value: str = "value",
    col: str = SNAPSHOT,
) -> DataFrame:
    """Cut fixed-width lines into trimmed fields; blank fields become null."""
    fields = [Slice(*f) for f in layout]
    cut = lines.select(
        *[_blank_to_null(F.substring(value, f.start, f.length)).alias(f.name) for f in fields]
    )
    return _clean(cut, date, col)


def split_delimited(
    lines: DataFrame,
    names: Sequence[str],
    sep: str = ",",
    date: DateLike | None = None,
    value: str = "value",
    col: str = SNAPSHOT,
) -> DataFrame:
    """Split lines on a literal separator; missing and blank fields are null."""
    parts = F.split(F.col(value), "\\Q" + sep + "\\E")
    cut = lines.select(
        *[_blank_to_null(F.get(parts, F.lit(i))).alias(name) for i, name in enumerate(names)]
    )
    return _clean(cut, date, col)


def read_fixed_width(
    spark: SparkSession,
    path: str,
    layout: Sequence[Slice | tuple[str, int, int]],
    date: DateLike | None = None,
    encoding: str = "utf-8",
    col: str = SNAPSHOT,
) -> DataFrame:
    """Fixed-width files (a path or glob) as rows."""
    return split_fixed_width(read_lines(spark, path, encoding), layout, date, col=col)


def read_delimited(
    spark: SparkSession,
    path: str,
    names: Sequence[str],
    sep: str = ",",
    date: DateLike | None = None,
    encoding: str = "utf-8",
    col: str = SNAPSHOT,
) -> DataFrame:
    """Delimited files without a header, fields taken by position."""
    return split_delimited(read_lines(spark, path, encoding), names, sep, date, col=col)


def read_csv_with_header(
    spark: SparkSession, path: str, schema: str, sep: str = ",", encoding: str = "utf-8"
) -> DataFrame:
    """CSV with a header row.  The schema is given, so no pass infers it."""
    reader = spark.read.schema(schema).option("header", True)
    return reader.option("sep", sep).option("encoding", encoding).csv(path)
