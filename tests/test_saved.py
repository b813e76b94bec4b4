from pyspark.sql import functions as F

from articlemill.operators import entities as E
from articlemill.operators import relations as R
from articlemill.sources.saved import save_by_key


def test_saved_mentions_serve_all_without_a_shuffle(spark, tmp_path):
    texts = {i: f"Ann Lee of York met Bob. Lee lives in Rome, York. Bob {i} for Acme" for i in range(40)} | {50: "", 51: None}
    docs = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id int, text string")
    terms = [("Ann", "PERSON"), ("Lee", "PERSON"), ("Bob", "PERSON"), ("York", "LOCATION"), ("Rome", "LOCATION"), ("Acme", "ORGANIZATION")]
    gazetteer = spark.createDataFrame(terms, "term string, type string")
    found = R.sentence_mentions(docs, ["doc_id"], "text", gazetteer, R.most_between(R.RELATION_RULES), bound=10)
    saved = save_by_key(found, "mentions_of_a_test", ["doc_id"], str(tmp_path / "m"), buckets=4)
    spans = saved.select("doc_id", "type", F.col("first").alias("begin"), F.col("last").alias("end"), "sent_id")
    served = {
        "relations": (R.pairs_of_mentions(saved, ["doc_id"]), R.relation_pairs(docs, ["doc_id"], "text", gazetteer, bound=10)),
        "aliases": (E.merge_aliases(saved, ["doc_id"]), E.merge_aliases(found, ["doc_id"])),
        "compiled": (E.compile_entities(saved, ["doc_id"]), E.compile_entities(found, ["doc_id"])),
        "ensemble": (E.combine_types(spans, ["doc_id"], [["PERSON"]]), None),
    }
    for name, (own, expected) in served.items():
        plan = own._jdf.queryExecution().executedPlan().toString()
        shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert not shuffles, (name, plan)
        if expected is not None:
            assert sorted(map(repr, own.collect())) == sorted(map(repr, expected.collect())), name
    assert len(saved.inputFiles()) <= 4
    spark.sql("DROP TABLE mentions_of_a_test")
