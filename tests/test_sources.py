import json
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from articlemill.schemas import ARTICLE_FIELDS
from articlemill.sources import articles as A
from articlemill.sources import docstore as D
from articlemill.sources import textfiles as T
from articlemill.sources.tables import by_document, scan_splits, spread


@pytest.fixture
def articles(spark):
    rows = [
        ("/1", "now", "11/11/15", "One", "First text", None),
        ("/2", "now", "", "Zwei für", 'Line\nbreak and "quotes"', "noncorruption"),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in ARTICLE_FIELDS))
    return df.select(*A.article_record())


def test_default_label(articles):
    assert {r["url"]: r["label"] for r in articles.collect()} == {"/1": "corruption", "/2": "noncorruption"}


def test_json_round_trip_one_file_each(spark, articles, tmp_path):
    path = str(tmp_path / "articles")
    assert A.write_articles_json(articles, path, one_per_file=True) == 2
    files = A.read_article_files(spark, path)
    assert files.count() == 2
    back = A.good_articles(A.decode_tolerant(files)).drop("path")
    assert sorted(back.collect()) == sorted(articles.collect())


def test_json_lines_round_trip_and_overwrite(spark, articles, tmp_path):
    path = str(tmp_path / "lines")
    A.write_articles_json(articles, path)
    A.write_articles_json(articles, path)
    assert sorted(A.read_article_lines(spark, path).collect()) == sorted(articles.collect())
    A.write_articles_json(articles, path, mode="append")
    assert A.read_article_lines(spark, path).count() == 4


BAD = ['{"title":"ok","content":"x"}', '{"title":"cut', "no json", "", "null", '{"extra":1,"title":"t"}']


def test_tolerant_decode_splits_good_and_bad(spark):
    raw = spark.createDataFrame([(i, v) for i, v in enumerate([*BAD, None])], "id int, value string")
    decoded = A.decode_tolerant(raw)
    assert sorted(r["id"] for r in A.good_articles(decoded).collect()) == [0, 5]
    assert sorted(r["id"] for r in A.rejected_articles(decoded).collect()) == [1, 2, 3, 4, 6]


def test_strict_decode_fails(spark):
    raw = spark.createDataFrame([(v,) for v in BAD[:2]], "value string")
    with pytest.raises(Exception, match="(?i)malformed"):
        A.decode_strict(raw).collect()
    good = spark.createDataFrame([(BAD[0],)], "value string")
    assert A.decode_strict(good).head()["title"] == "ok"


def test_article_json_and_id(articles):
    row = articles.filter("url = '/2'").select(A.article_json().alias("j")).head()
    assert json.loads(row["j"])["content"] == 'Line\nbreak and "quotes"'
    ids = [r["article_id"] for r in A.with_article_id(articles).collect()]
    assert ids == [r["article_id"] for r in A.with_article_id(articles).collect()]
    assert len(set(ids)) == 2


@pytest.fixture
def people(spark):
    rows = spark.createDataFrame([("Alice", 25), ("Bob", 30), ("Carl", 20)], "name string, age int")
    return D.envelope(rows, F.col("name"), "Person", F.struct("name", "age"))


def test_store_views(spark, people):
    other = D.envelope(spark.range(1), F.lit("x"), "Other", F.struct(F.lit("x").alias("name"), F.lit(1).alias("age")))
    store = people.unionByName(other)
    assert D.all_docs(people).columns == ["_id", "name", "age"]
    assert D.metadata(store).count() == 4
    assert {r["key"] for r in D.view_by_kind(store, "Person").collect()} == {"Alice", "Bob", "Carl"}
    view = D.key_value_view(people, F.col("_id"), F.col("doc.age"), F.col("doc.name"))
    assert [(r["key"], r["value"]) for r in view.collect()] == [(20, "Carl"), (25, "Alice"), (30, "Bob")]


def test_lookup_by_list_long_list_and_table(spark, monkeypatch):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert D.lookup_by_ids(df, "k", [3, 5, 500]).count() == 2
    monkeypatch.setattr(D, "MAX_INLINE_KEYS", 2)
    assert D.lookup_by_ids(df, "k", [3, 5, 500]).count() == 2
    keys = spark.createDataFrame([(3,), (3,), (7,)], "k bigint")
    assert sorted(r["k"] for r in D.lookup_by_ids(df, "k", keys).collect()) == [3, 7]


def test_rekey_and_collections(spark, people, tmp_path):
    path = str(tmp_path / "people")
    copies = D.rekey(D.all_docs(people), "_id", "my_", ["name"])
    D.replace_collection(copies, path)
    D.replace_collection(copies, path)
    D.append_collection(copies, path)
    back = spark.read.parquet(path)
    assert back.count() == 6
    assert {r["_id"] for r in back.collect()} == {"my_Alice", "my_Bob", "my_Carl"}


def test_dictionary_round_trip(spark, tmp_path):
    counts = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9)], "word string, cnt bigint")
    path = str(tmp_path / "dict")
    T.write_dictionary(counts, path, 3)
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert lines == ["(c,9)", "(a,5)", "(b,5)"]
    assert sorted(T.read_dictionary(spark, path).collect()) == sorted(counts.collect())
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1


def test_training_lines_and_texts(spark, tmp_path):
    df = spark.createDataFrame([("corruption", "two\nlines "), ("noncorruption", "x")], "label string, content string")
    path = str(tmp_path / "train")
    T.write_training_lines(df, path)
    T.write_training_lines(df, path)
    lines = sorted(r["value"] for r in spark.read.text(path).collect())
    assert lines == ["corruption two lines"] * 2 + ["noncorruption x"] * 2
    T.write_text(df, "label", str(tmp_path / "t"))
    assert spark.read.text(str(tmp_path / "t")).count() == 2


def test_stopword_file(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("a\nthe\n\na\nwould\n")
    words = T.read_stopwords(spark, str(tmp_path / "stop.txt"))
    assert sorted(r["word"] for r in words.collect()) == ["a", "the", "would"]


def test_frontier(spark):
    rows = T.page_frontier(spark, "http://x/?start=", 1980).collect()
    assert len(rows) == 100
    assert rows[-1]["url"] == "http://x/?start=1980"


def test_placing(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    cores = spark.sparkContext.defaultParallelism
    assert scan_splits(table) == 1
    assert spread(table, "id").rdd.getNumPartitions() == cores
    assert by_document(table, "id").rdd.getNumPartitions() == cores
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100b")
    try:
        splits = scan_splits(table)
        assert splits > 2 * cores
        assert "Exchange" not in spread(table, "id")._jdf.queryExecution().toString()
        assert by_document(table, "id").rdd.getNumPartitions() == splits
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    in_memory = spark.createDataFrame([(i,) for i in range(10)], "id int")
    assert spread(in_memory, "id").count() == by_document(in_memory, "id").count() == 10


def test_odd_dictionary_words_come_back(spark, tmp_path):
    odd = [("über", 4), (",", 3), ("don't", 2), ("", 2), ("(a,b)", 1), ("two words", 1)]
    counts = spark.createDataFrame(odd, "word string, cnt bigint")
    T.write_dictionary(counts, str(tmp_path / "dict"), 10)
    assert sorted(T.read_dictionary(spark, str(tmp_path / "dict")).collect()) == sorted(counts.collect())
    assert T.rejected_dictionary_lines(spark, str(tmp_path / "dict")).count() == 0
    T.write_dictionary(counts, str(tmp_path / "top"), 2)
    assert [r["word"] for r in T.read_dictionary(spark, str(tmp_path / "top")).collect()] == ["über", ","]
    (tmp_path / "bad.txt").write_text("(a,1)\n(b)\nc,2\n")
    assert [r["value"] for r in T.rejected_dictionary_lines(spark, str(tmp_path / "bad.txt")).collect()] == ["(b)", "c,2"]


def test_rejects_are_counted_and_records_parsed_once(spark):
    raw = spark.createDataFrame([(v,) for v in BAD], "value string")
    seen = Observation()
    good = A.good_articles(A.decode_tolerant(raw), rejects=seen)
    assert len(good.collect()) == 2
    assert seen.get == {"rejected": 4, "read": 6}
    plan = A.good_articles(A.decode_tolerant(raw))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
