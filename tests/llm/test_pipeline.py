"""Every stage against a brute-force version, on what the stage before has kept."""

import hashlib
import struct
from pathlib import Path

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from tests.llm.test_minhash import brute as groups
from tests.llm.test_substring_dedup import brute as repeats
from tidemark.llm.toxicity import fit_toxicity, toxicity_scores

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before = docs
    results = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, before, SF)
        out.write.parquet(str(tmp_path / name))
        before = spark.read.parquet(str(tmp_path / name))
        if i < 4:
            assert before.columns == COLUMNS
        results.append(before)
    clean, near, short, mixed, ids = results
    rejected = {r.doc_id for r in toxicity_scores(docs, fit_toxicity(docs, labels)).where("predicted = 1").collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.text for r in clean.collect()} == {i: t for i, t in text.items() if i not in rejected}
    kept = {i for i, _, _, k in groups([(r.doc_id, r.text) for r in clean.collect()], 80) if k}
    assert {r.doc_id: r.text for r in near.collect()} == {i: text[i] for i in kept}
    expected = {i: (text[i] if not gone else k) for i, _, gone, k in repeats([(i, text[i]) for i in kept], 20)}
    assert {r.doc_id: r.text for r in short.collect()} == expected
    assert all(r.n_chars == len(r.text) for r in short.collect())
    assert {r.doc_id: r.text for r in mixed.collect()} == expected
    ranks = corpus_pipeline.Vocabulary.load(P.path(corpus_pipeline.TOKENIZER)).ranks
    reference = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in ids.collect():
        own = reference.encode_ordinary(expected[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(own)}I", *own)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(expected[r.doc_id].encode()).hexdigest()
    again = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, ids.collect()))
    assert Path(corpus_pipeline.__file__).parent == Path(__file__).resolve().parents[2]
