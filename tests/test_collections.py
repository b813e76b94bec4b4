import glob
import os

import pytest
from pyspark.sql import functions as F

from articlemill.sources import collections as C
from articlemill.sources import docstore as D
from articlemill.sources import key_view as V

SCHEMA = "_id string, n int, text string"


def files_of(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*/part-*")}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_saving_twice_leaves_one_row_per_id(spark, tmp_path):
    path = str(tmp_path / "c")
    first = spark.createDataFrame([(f"d{i}", i, None if i == 3 else f"text {i}") for i in range(100)], SCHEMA)
    assert C.save_by_id(first, path, buckets=8) == list(range(8))
    once = rows(C.read_collection(spark, path))
    C.save_by_id(first, path)
    assert rows(C.read_collection(spark, path)) == once == rows(first)
    before = files_of(path)
    new = spark.createDataFrame([("d5", 500, "again"), ("d5", 400, "not the last"), ("new", 1, None)], SCHEMA)
    touched = C.save_by_id(new, path, order="n")
    assert 1 <= len(touched) <= 2
    after = files_of(path)
    same = {f for f in before if int(f.split("=")[1].split("/")[0]) not in touched}
    assert len(same) >= 6 and all(after[f] == before[f] for f in same)
    found = {r[0]: tuple(r) for r in C.read_collection(spark, path).collect()}
    assert len(found) == 101 and found["d5"] == ("d5", 500, "again") and found["d6"] == ("d6", 6, "text 6")
    assert rows(C.read_by_ids(spark, path, "_id", ["d5", "new", "none"])) == [("d5", 500, "again"), ("new", 1, None)]
    read = C.read_by_ids(spark, path, "_id", ["d5"]).inputFiles()
    assert len(read) >= 1 and C.stored_buckets(spark, path) == 8


def test_odd_saves(spark, tmp_path):
    path = str(tmp_path / "c")
    none = spark.createDataFrame([], SCHEMA)
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x")], SCHEMA)
    C.save_by_id(df, path, buckets=4)
    assert C.save_by_id(none, path) == []
    assert rows(C.read_collection(spark, path)) == [("a", 1, "x")]
    with pytest.raises(Exception, match="without id"):
        C.save_by_id(spark.createDataFrame([(None, 1, "x"), ("b", 2, "y")], SCHEMA), path)
    assert rows(C.read_collection(spark, path)) == [("a", 1, "x")]
    wider = spark.createDataFrame([("b", 2, True)], "_id string, n int, seen boolean")
    C.save_by_id(wider, path)
    found = {r._id: r.asDict() for r in C.read_collection(spark, path).collect()}
    assert found == {"a": {"_id": "a", "n": 1, "text": "x", "seen": None}, "b": {"_id": "b", "n": 2, "text": None, "seen": True}}
    # The same id twice in one save, without an order: the same one each time.
    many = spark.createDataFrame([("c", i, str(i)) for i in range(20)], SCHEMA)
    C.save_by_id(many, str(tmp_path / "d"), buckets=4)
    C.save_by_id(many.orderBy(F.desc("n")).repartition(3), str(tmp_path / "e"), buckets=4)
    assert rows(C.read_collection(spark, str(tmp_path / "d"))) == rows(C.read_collection(spark, str(tmp_path / "e")))


def test_a_range_reads_its_files_only(spark, tmp_path):
    path, data = str(tmp_path / "v"), [(i % 500 if i % 7 else None, i) for i in range(3000)]
    V.write_view(spark.createDataFrame(data, "key int, n int"), path, "key", files=10)
    assert len(glob.glob(f"{path}/rows/part-*")) == 10
    found = V.read_range(spark, path, "key", 100, 120)
    assert rows(found) == sorted([r for r in data if r[0] is not None and 100 <= r[0] <= 120], key=repr)
    assert len(found.inputFiles()) <= 3
    keys = [r.key for r in V.read_range(spark, path, "key").collect()]
    assert keys == sorted((k for k, _ in data), key=lambda k: (k is not None, k or 0)) and keys[0] is None
    assert [r.key for r in V.read_range(spark, path, "key", end=3).collect()].count(None) == keys.count(None)
    down = [r.key for r in V.read_range(spark, path, "key", 490, descending=True, limit=9).collect()]
    assert down == sorted([k for k in keys if k is not None and k >= 490], reverse=True)[:9]
    assert V.read_range(spark, path, "key", 900).count() == 0 and V.read_range(spark, path, "key", 5, 4).count() == 0


def test_a_hot_key_takes_several_files_and_empty_views_work(spark, tmp_path):
    path = str(tmp_path / "v")
    V.write_view(spark.createDataFrame([(7 if i % 3 else i, i) for i in range(6000)], "key int, n int"), path, "key", files=8)
    sizes = [r.n for r in spark.read.parquet(f"{path}/files").collect()]
    assert max(sizes) < 2 * 6000 / 8 and V.read_range(spark, path, "key", 7, 7).count() == 4000
    V.write_view(spark.createDataFrame([], "key int, n int"), path, "key")
    assert V.read_range(spark, path, "key", 1, 2).count() == 0 and V.read_range(spark, path, "key").count() == 0


def test_inferred_schemas(spark):
    texts = ['{"a": 1, "b": {"c": "x"}}', '{"a": 2.5, "d": [1, 2]}', '{"odd key": true}', None, "not json", '{"a": null}']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, json string")
    found = {r.id: r.doc for r in D.with_inferred_fields(df, "json").collect()}
    assert float(found[0]["a"]) == 1 and float(found[1]["a"]) == 2.5 and found[0]["b"]["c"] == "x" and list(found[1]["d"]) == [1, 2]
    assert found[2]["odd key"] is True and found[3] is None and found[5]["a"] is None
    assert D.inferred_schema(df.limit(0), "json") == "STRUCT<>"
