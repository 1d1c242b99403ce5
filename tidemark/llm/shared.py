"""The shared folder and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="llm-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors reach, as ``spark.checkpoint.dir`` names it.

    Only a ``local`` session without the setting gets a temporary folder.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {SETTING} to a folder that all executors can reach")
    return _own_folder()


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there, and a
    lost executor costs no more than reading the files."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_caches: dict[str, Callable[[], None]] = {}


def keeps(name: str, forget: Callable[[], None]) -> None:
    """Says how to give back what an operator keeps in a Python worker between tasks."""
    _caches[name] = forget


def alone(name: str) -> None:
    """Called by an operator's tasks: what other operators have left in the worker goes."""
    for other, forget in _caches.items():
        if other != name:
            forget()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this library to the Python workers, once per application, so that they need not
    have it installed or be started in its folder."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="llm-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
