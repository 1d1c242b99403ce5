"""Loan commitments: one row per file with its running step and disbursement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import keep_group_extremes
from tidemark.operators.shaping import Dimension, star_enrich


def loan_commitments(
    files: DataFrame,
    steps: DataFrame,
    parts: Sequence[tuple[DataFrame, dict[str, str]]],
    labels: tuple[str, str],
    file: str = "file",
) -> DataFrame:
    """Files that every part knows, with the current step of their schedule.

    ``files(file, nominal, ...)``; ``steps(file, step, disbursed, ...)``, of which the one
    with the highest number counts; ``parts`` are tables with a ``file`` column and the
    columns to take (new name -> column).  ``labels`` name a partial and a total
    disbursement: total is one that equals the nominal, or whose amounts are not known.
    All joins are on the file, so each table is shuffled once.
    """
    current = keep_group_extremes(steps, file, "step")
    taken = {c: c for c in steps.columns if c != file}
    tables = [(current, taken), *parts]
    dims = [Dimension(df, {file: file}, take, "inner") for df, take in tables]
    partial = F.col("disbursed") != F.col("nominal")
    label = F.when(partial, labels[0]).otherwise(labels[1])
    return star_enrich(files, dims).withColumn("disbursement", label)
