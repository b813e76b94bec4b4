import hashlib

import corpus_pipeline
from articlemill.llm.common import stored
from tests.llm.frames import odd_documents

SMALL = "/root/testdata/sf0.001"


def test_each_stage_keeps_the_columns_and_the_last_encodes(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    schema, texts, counts = docs.schema, {}, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, SMALL), name)
        counts.append(docs.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in schema], name
            texts = {r.doc_id: r.text for r in docs.collect()}
    assert counts == sorted(counts, reverse=True) and 0 < counts[-1] < 200
    for r in docs.collect():
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() and r.n_tokens == len(r.ids)
    whole = corpus_pipeline.run(spark, SMALL)
    assert sorted(r.ids_sha256 for r in whole.collect()) == sorted(r.ids_sha256 for r in docs.collect())


def test_odd_and_empty_tables_pass_through(spark):
    for docs in (odd_documents(spark).withColumnRenamed("source", "hits"), odd_documents(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SMALL), name)
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
