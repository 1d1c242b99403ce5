"""The place in the mix reaches the rows of the last stage."""

import corpus_pipeline
from tidemark.llm.mixing import mixed, with_read_position

SF = "/root/testdata/sf0.001"


def test_the_mix_decides_the_positions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    corpus_pipeline.mix_sources(spark, docs, SF).write.parquet(str(tmp_path / "mix"))
    reread = spark.read.parquet(str(tmp_path / "mix"))
    out = corpus_pipeline.tokenize(spark, reread, SF).collect()
    assert sorted(r.mix_position for r in out) == list(range(docs.count()))
    places = {r.doc_id: r.mix_position for r in mixed(docs, corpus_pipeline.WEIGHTS).collect()}
    assert {r.doc_id: r.mix_position for r in out} == places
    assert any(places[r.doc_id] != i for i, r in enumerate(docs.sort("doc_id").collect()))


def test_files_in_the_order_of_their_numbers(spark, tmp_path):
    # Later files are larger, so a scan reads them first.
    rows = spark.range(0, 1000).selectExpr("id", "cast(floor(sqrt(id / 40)) as int) as part", "repeat('x', 100) as t")
    rows.repartitionById(5, rows.part).sortWithinPartitions("id").drop("part").write.parquet(str(tmp_path / "t"))
    out = with_read_position(spark.read.parquet(str(tmp_path / "t"))).collect()
    assert len(out) == 1000 and all(r.id == r.mix_position for r in out)
    spark.createDataFrame([], "id long").write.parquet(str(tmp_path / "none"))
    assert with_read_position(spark.read.parquet(str(tmp_path / "none"))).collect() == []
