"""Where a job may put tables of its own."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the session.  There is no fallback:
    a folder of one machine would be seen by that machine only."""
    folder = spark.conf.get(SETTING, None)
    if not folder:
        raise ValueError(f"set {SETTING} to a folder that all executors can reach")
    return folder


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new sub-folder of the shared one that nobody else uses."""
    return unused(shared_folder(spark), name)


def unused(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
