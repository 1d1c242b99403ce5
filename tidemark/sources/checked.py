"""Text extracts whose bad lines are kept apart instead of becoming nulls."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.text import Slice

LINE, FILE, REASONS = "line", "file", "reasons"


class Field(NamedTuple):
    """A field and its type; ``required`` refuses a blank one."""

    name: str
    kind: str = "string"
    required: bool = False


class Checked(NamedTuple):
    """What one pass over the lines has given."""

    rows: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def _decoded(encoding: str) -> tuple[Column, Column]:
    """(text of a line, whether its bytes are no text in the encoding)."""
    raw = F.col("value").cast("binary")
    if encoding.lower().replace("_", "-") in ("utf-8", "utf8"):
        return F.col("value"), ~F.is_valid_utf8(F.col("value"))
    text = F.decode(raw, encoding)
    return text, F.contains(text, F.lit("�"))


def _judged(lines: DataFrame, texts: list[Column], fields: Sequence[Field], broken: Column, short: Column) -> DataFrame:
    """The fields cast to their types, and why a line is refused."""
    made, reasons = [], [F.when(broken, F.lit("undecodable")), F.when(~broken & short, F.lit("short"))]
    sound = ~broken & ~short
    for text, field in zip(texts, fields, strict=True):
        blank = F.nullif(F.trim(text), F.lit(""))
        value = blank if field.kind == "string" else blank.try_cast(field.kind)
        made.append(value.alias(field.name))
        reasons.append(F.when(sound & blank.isNotNull() & value.isNull(), F.lit(f"{field.name}: no {field.kind}")))
        if field.required:
            reasons.append(F.when(sound & blank.isNull(), F.lit(f"{field.name}: missing")))
    return lines.select(
        F.col("_metadata.file_path").alias(FILE), F.col("value").alias(LINE), *made, F.array_compact(F.array(*reasons)).alias(REASONS)
    )


def judge_fixed_width(
    spark: SparkSession, path: str, layout: Sequence[Slice | tuple[str, int, int]], fields: Sequence[Field], encoding: str = "utf-8"
) -> DataFrame:
    """Fixed-width lines as (file, line, the fields, reasons); no reasons: the line is sound.

    A line is short if its last field is cut.  A blank line has only blank fields.
    """
    lines, slices = spark.read.text(path), [Slice(*f) for f in layout]
    text, broken = _decoded(encoding)
    width = max(f.start + f.length - 1 for f in slices)
    texts = [F.substring(text, f.start, f.length) for f in slices]
    return _judged(lines, texts, fields, broken, F.length(text) < width)


def judge_delimited(
    spark: SparkSession, path: str, fields: Sequence[Field], sep: str = ",", encoding: str = "utf-8"
) -> DataFrame:
    """Delimited lines as :func:`judge_fixed_width` gives them; a line with fewer fields is
    short, further fields are not looked at."""
    lines = spark.read.text(path)
    text, broken = _decoded(encoding)
    parts = F.split(text, "\\Q" + sep + "\\E")
    texts = [F.get(parts, F.lit(i)) for i in range(len(fields))]
    return _judged(lines, texts, fields, broken, F.size(parts) < len(fields))


def load_checked(judged: DataFrame, folder: str) -> Checked:
    """Writes judged lines once, sound and refused ones to partitions of ``folder``, and
    returns both with the counts of the pass.

    The lines are read and judged in that one pass; ``counts`` are observed during it:
    lines, rows, rejected.  Every line is in exactly one of both outputs, of which the
    refused ones keep file, line and reasons.
    """
    spark = judged.sparkSession
    sound = F.size(REASONS) == 0
    seen = Observation("checked lines")
    watched = judged.withColumn("sound", sound).observe(
        seen, F.count(F.lit(1)).alias("lines"), F.count_if("sound").alias("rows"), F.count_if(~F.col("sound")).alias("rejected")
    )
    watched.write.partitionBy("sound").parquet(folder)
    found = spark.read.schema(judged.schema.add("sound", "boolean")).parquet(folder)
    fields = [c for c in judged.columns if c not in (FILE, LINE, REASONS)]
    return Checked(
        found.where("sound").select(FILE, *fields),
        found.where("NOT sound").select(FILE, LINE, REASONS),
        {k: int(v) for k, v in seen.get.items()},
    )
