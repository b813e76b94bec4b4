"""Long and odd texts, as a crawl has them: no step may be quadratic or recurse per character."""

import time

from pyspark.sql import functions as F

from articlemill.functions import html as H
from articlemill.functions import text as X
from articlemill.operators import entities as E
from articlemill.operators import relations as R
from articlemill.operators import spans as S
from articlemill.operators.selectors import select_elements

N = 200_000


# Of 20,000 "Obama saw America" each name is paired with the next three tokens' names, up to the end.


def docs_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_long_texts_keep_every_token(spark):
    docs = docs_of(spark, "word " * N, "x" * N, "a.b@" + "c." * N + "org", "$1" + ",000" * N, "." * N)
    start = time.time()
    per_doc = {
        r["doc_id"]: (r["n"], r["last"])
        for r in S.token_spans(docs, ["doc_id"], "text")
        .groupBy("doc_id").agg(F.count("*").alias("n"), F.max("end").alias("last")).collect()
    }
    assert per_doc[0] == (N, 5 * N - 1) and per_doc[1] == (1, N)
    found = E.entity_spans(docs, ["doc_id"], "text").groupBy("type").count().collect()
    assert {r["type"]: r["count"] for r in found} == {"EMAIL": 1, "MONEY": 1, "NUMBER": N + 1}
    sizes = docs.select("doc_id", F.size(X.tokens(F.col("text"))).alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in sizes} == {0: N, 1: 1, 2: 1, 3: 0, 4: 0}
    assert time.time() - start < 90


def test_many_mentions_in_one_sentence(spark):
    docs = docs_of(spark, "Obama saw America " * 20_000)
    gazetteer = spark.createDataFrame([("Obama", "PERSON"), ("America", "LOCATION")], "term string, type string")
    start = time.time()
    assert R.relation_pairs(docs, ["doc_id"], "text", gazetteer).count() == 79_997
    spans = E.gazetteer_spans(docs, ["doc_id"], "text", gazetteer)
    shifted = spans.withColumn("begin", F.col("begin") + 1)
    assert E.combine_taggers([spans, shifted], ["doc_id"]).count() == 40_000
    assert time.time() - start < 60


def test_large_broken_pages(spark):
    html = "<article>" + "<p><b>x &amp; y" * 20_000
    closed = html + "</article>"
    pages = spark.createDataFrame([(0, html), (1, closed)], "page_id int, html string")
    start = time.time()
    texts = pages.select("page_id", H.element_text(H.strip_noise(F.col("html")), "article").alias("t"))
    assert {r["page_id"]: len(r["t"].split()) for r in texts.collect()} == {0: 0, 1: 60_000}
    paragraphs = select_elements(pages, ["page_id"], "html", [("p", "article p")]).groupBy("page_id").count()
    assert {r["page_id"]: r["count"] for r in paragraphs.collect()} == {0: 20_000, 1: 20_000}
    assert time.time() - start < 60
