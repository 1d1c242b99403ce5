"""From raw documents to token ids: five stages, each a Parquet table the next one reads.

toxicity -> MinHash near-dedup -> substring dedup -> mixing -> byte-level BPE
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from functools import wraps
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bpe import Vocabulary, bpe_report
from tidemark.llm.minhash import without_near_duplicates
from tidemark.llm.mixing import WEIGHTS, in_mixed_order, with_read_position
from tidemark.llm.shared import shared_folder, ship
from tidemark.llm.substring_dedup import without_repeats
from tidemark.llm.toxicity import fit_toxicity, without_toxic

TOKENIZER = "byte_bpe_50k.tiktoken"


def stage(fn):
    """A stage whose Python workers have the library."""

    @wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, docs, sf_dir)

    return run


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from the labelled ones, rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return without_toxic(docs, fit_toxicity(docs, labels))


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return without_near_duplicates(docs)


@stage
def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages stay where they stand first."""
    return without_repeats(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, laid out so that any run of them has the target weights."""
    return in_mixed_order(docs, WEIGHTS)


@stage
def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's token ids, the digest of the text decoded, and the
    document's place in the mix, which is that of its row in the files that ``docs`` is read from."""
    vocabulary = Vocabulary.load(public_tokenizers.path(TOKENIZER))
    return bpe_report(with_read_position(docs), vocabulary, "mix_position")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("mixing", mix_sources),
    ("byte_bpe", tokenize),
]
# A trained model's decisions are none of SQL's; the tests replay every stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, step in STAGES[:-1]:
        path = f"{folder}/{name}"
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
