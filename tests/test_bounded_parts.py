"""What a task holds does not grow with the table: documents are placed in parts by their stored bytes."""

import pytest
from pyspark.sql import functions as F

from articlemill.functions.text import raw_tokens, tokens
from articlemill.operators import classify, counts, relations
from articlemill.operators import tagger as G
from articlemill.sources import tables
from catalog import entities
from catalog import text as catalog_text


@pytest.fixture
def folder(spark, tmp_path, monkeypatch):
    """A folder with a table of documents of more than ten parts."""
    rows = [(i, f"Ann Lee of York met word{i} in Rome {i}. Then others came to York") for i in range(400)]
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    size = tables.scan_bytes(spark.read.parquet(str(tmp_path / "documents.parquet")))
    monkeypatch.setattr(tables, "PART_BYTES", size // 10)
    return str(tmp_path)


def placed_in(df):
    """Numbers of parts in which a plan places documents."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [int(line.rstrip().rsplit(", ", 1)[1]) for line in plan.splitlines() if "RepartitionByExpression" in line]


def test_documents_are_placed_by_stored_bytes(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert tables.scan_splits(docs) == 1
    parts = tables.scan_parts(docs)
    assert parts in (10, 11)
    assert tables.by_document(docs, "doc_id").rdd.getNumPartitions() == parts
    gazetteer = spark.createDataFrame([("York", "LOCATION")], "term string, type string")
    dictionary = spark.createDataFrame([("york",)], "word string")
    named = docs.select(F.lit(0.0).alias("category"), tokens(F.col("text")).alias("tokens"))
    model = classify.train_document_categoriser(named)
    for frame in [
        counts.document_counts(docs, "doc_id", raw_tokens(F.col("text"))),
        counts.dictionary_scores(docs, ["doc_id"], raw_tokens(F.col("text")), dictionary),
        classify.predict_categories(model, docs.select("doc_id", tokens(F.col("text")).alias("tokens")), ["doc_id"]),
        relations.relation_pairs(docs, ["doc_id"], "text", gazetteer, bound=1),
        G.tagged_sentences(docs, ["doc_id"], "text", gazetteer, bound=1),
        catalog_text.token_ngrams(spark, folder),
    ]:
        assert parts in placed_in(frame)


def test_saved_mentions_have_buckets_by_stored_bytes(spark, folder, monkeypatch):
    monkeypatch.setattr(tables, "PART_BYTES", tables.PART_BYTES // 20)
    asked = []
    monkeypatch.setattr(entities, "save_by_key", lambda df, table, keys, path, buckets=64: asked.append(buckets) or df)
    entities.saved_mentions(spark, folder)
    assert asked == [tables.scan_parts(entities.documents(spark, folder))] and asked[0] >= 200
