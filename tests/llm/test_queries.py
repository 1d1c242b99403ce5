"""The registered queries, their SQL on the smallest tables, and their columns."""

import pytest

from tests.oracle import compare, connect
from tidemark.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_": ["vec_id bigint", "n_links bigint", "component_id bigint", "kept boolean"],
    "op2_": ["doc_id bigint", "size bigint", "text_crc32 bigint", "law string", "shard int", "slot bigint", "grown_shard int"],
    "op3_": ["doc_id bigint", "n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"],
    "op4_": ["doc_id bigint", "mix_position bigint"],
    "op5_": ["doc_id bigint", "held_out boolean", "score double", "predicted int"],
    "op6_": ["doc_id bigint", "n_chars bigint", "edited_sha256 string", "fingerprint string", "edited_fingerprint string", "near_edited double", "near_next double"],
    "op7_": ["conv_id bigint", "n_turns bigint", "turns_sha256 string", "loss_chars bigint", "loss_sha256 string", "formatted_chars bigint"],
    "op8_": ["doc_id bigint", "n_words bigint", "n_removed bigint", "kept_sha256 string"],
    "op9_": ["doc_id bigint", "n_shingles bigint", "component_id bigint", "kept boolean"],
    "op10_": ["doc_id bigint", "held_out boolean", "n_tokens bigint", "n_known bigint", "train_tokens bigint", "base_score double", "score double"],
    "op11_": [f"{c} bigint" for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + ["groups_sha256 string"],
    "op12_": ["doc_id bigint", "n_words bigint", "n_base bigint", "first_word bigint", "last_word bigint", "base_labels string", "labels string", "score double"],
    "op13_": ["conv_id bigint", "gaps bigint", "blank bigint", "duplicate bigint", "truncated bigint", "illegal bigint", "cost bigint", "audit string", "repaired_sha256 string"],
}
TABLE = {"op1_": "embeddings", "op7_": "conversations", "op13_": "conversations"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_equal_to_sql(spark, name):
    problem, n = compare(spark, connect(SF_DIR), SF_DIR, QUERIES[name], ORACLES[name])
    assert problem == "" and n > 0


@pytest.mark.parametrize("prefix", list(COLUMNS))
def test_columns_and_whole_tables(spark, prefix):
    (name,) = [n for n in QUERIES if n.startswith(prefix)]
    out = QUERIES[name](spark, SF_DIR)
    kinds = [" ".join(d) for d in out.dtypes]
    assert [c for c in COLUMNS[prefix] if c not in kinds] == []
    table = spark.read.parquet(f"{SF_DIR}/{TABLE.get(prefix, 'documents')}.parquet")
    if prefix in ("op7_", "op13_"):
        assert out.count() == table.select("conv_id").distinct().count() + (prefix == "op7_")
    else:
        assert out.count() == table.count()


def test_one_query_per_operator_and_the_pipeline():
    assert {n.split("_")[0] for n in QUERIES} == {"pipeline", *(p[:-1] for p in COLUMNS)}
    assert len(QUERIES) == 1 + len(COLUMNS)
