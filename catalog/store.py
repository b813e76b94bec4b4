"""Article files, document store views, lookups and text outputs."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import functions as F

from articlemill.operators.classify import training_union as union_of
from articlemill.schemas import DEFAULT_LABEL, NEGATIVE_LABEL
from articlemill.sources import docstore as D
from articlemill.sources.articles import decode_tolerant, good_articles, rejected_articles
from articlemill.sources.collections import read_collection, save_by_id
from articlemill.sources.key_view import read_range, write_view
from articlemill.sources.scratch import scratch_path
from articlemill.sources.tables import read_table, spread
from articlemill.sources.textfiles import page_frontier as frontier
from articlemill.sources.textfiles import training_line

CUT_LANGUAGE = "fr"
BASE_URL = "https://news.example.org/collection?b_start:int="


def article_texts(spark, sf):
    """Documents as JSON articles, of which those in one language are cut short."""
    docs = spread(read_table(spark, sf, "documents"), "doc_id")
    article = F.struct(
        F.concat(F.lit("/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("source").alias("title"),
        F.col("text").alias("content"),
        F.col("lang").alias("label"),
    )
    whole = F.to_json(article)
    cut = F.left(whole, F.length(whole) - 3)
    text = F.when(F.col("lang") == CUT_LANGUAGE, cut).otherwise(whole)
    return docs.select("doc_id", text.alias("value"))


def json_articles_tolerant(spark, sf):
    return good_articles(decode_tolerant(article_texts(spark, sf)))


def json_articles_rejected(spark, sf):
    bad = rejected_articles(decode_tolerant(article_texts(spark, sf)))
    return bad.select("doc_id", F.length("_corrupt").alias("n_chars"))


def store(spark, sf):
    none = F.lit(None).cast("string")

    def doc(lang, source):
        return F.struct(F.col("text"), lang.alias("lang"), source.alias("source"))

    documents, turns, items = (
        read_table(spark, sf, t) for t in ("documents", "conversations", "benchmark")
    )
    turn_id = F.concat_ws("-", F.lit("turn"), F.col("conv_id"), F.col("turn"))
    return reduce(lambda a, b: a.unionByName(b), [
        D.envelope(
            documents, F.concat_ws("-", F.lit("article"), F.col("doc_id")), "article",
            doc(F.col("lang"), F.col("source")),
        ),
        D.envelope(turns, turn_id, "turn", doc(none, F.col("role"))),
        D.envelope(items, F.concat_ws("-", F.lit("item"), F.col("item_id")), "item", doc(none, none)),
    ])


def docstore_all(spark, sf):
    return D.all_docs(store(spark, sf))


def docstore_metadata(spark, sf):
    return D.metadata(store(spark, sf))


def view_by_kind(spark, sf):
    view = D.view_by_kind(store(spark, sf), "turn")
    return view.select("key", F.col("value.text").alias("text"), F.col("value.source").alias("source"))


def view_time_title(spark, sf):
    orders = read_table(spark, sf, "orders")
    return D.key_value_view(
        orders, F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderpriority")
    )


def lookup_by_ids(spark, sf):
    orders = read_table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'")
    keys = orders.select(F.col("o_custkey").alias("c_custkey"))
    return D.lookup_by_ids(read_table(spark, sf, "customer"), "c_custkey", keys)


def scan_filter_type(spark, sf):
    return read_table(spark, sf, "events").filter("event_type = 'purchase'")


def select_sort_limit(spark, sf):
    part = read_table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    return part.orderBy(F.desc("p_name"), "p_partkey").limit(10)


def rekey_project(spark, sf):
    customer = read_table(spark, sf, "customer").withColumnRenamed("c_name", "name")
    return D.rekey(customer, "c_custkey", "my_", ["name"])


def page_frontier(spark, sf):
    return frontier(spark, BASE_URL, read_table(spark, sf, "pages").count())


def labelled(spark, sf):
    return read_table(spark, sf, "documents").join(read_table(spark, sf, "labels"), "doc_id")


def doccat_train_lines(spark, sf):
    label = F.when(F.col("toxic") == 1, DEFAULT_LABEL).otherwise(NEGATIVE_LABEL)
    line = training_line(label, F.col("text")).alias("value")
    return labelled(spark, sf).select("doc_id", line)


def training_union(spark, sf):
    docs = labelled(spark, sf)
    positive = docs.filter("toxic = 1").select("doc_id", "text")
    return union_of(positive, docs.filter("toxic = 0").select("doc_id", "text"))


def saved_by_id(spark, sf):
    """All customers saved, then those in debt saved again under another segment, into the same collection."""
    customers = read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    path = scratch_path(spark, "customers")
    save_by_id(customers, path, "c_custkey")
    save_by_id(customers.filter("c_acctbal < 0").withColumn("c_mktsegment", F.lit("DEBT")), path, "c_custkey")
    return read_collection(spark, path)


def view_key_range(spark, sf):
    """The view of orders by date, written once, of which some months are read."""
    orders = read_table(spark, sf, "orders").select("o_orderdate", "o_orderkey", "o_orderpriority")
    path = scratch_path(spark, "orders_by_date")
    write_view(orders, path, "o_orderdate", files=16)
    return read_range(spark, path, "o_orderdate", datetime(1995, 1, 1), datetime(1995, 3, 31))


def inferred_documents(spark, sf):
    """Stored JSON whose schema nobody gave: the properties of events, and pages as objects."""
    pages = read_table(spark, sf, "pages").select(F.col("page_id").alias("id"), F.to_json(F.struct("url", F.length("html").alias("size"))).alias("json"))
    events = read_table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("props").alias("json"))
    return D.with_inferred_fields(events.unionByName(pages), "json").select("id", "doc.*")


QUERIES = {
    f.__name__: f
    for f in [
        json_articles_tolerant, json_articles_rejected, docstore_all, docstore_metadata,
        view_by_kind, view_time_title, lookup_by_ids, scan_filter_type, select_sort_limit,
        rekey_project, page_frontier, doccat_train_lines, training_union,
        saved_by_id, view_key_range, inferred_documents,
    ]
}


def oracles() -> dict[str, str]:
    envelopes = """(
        SELECT 'article-' || doc_id AS _id, 'article' AS kind, text, lang, source FROM documents
        UNION ALL SELECT 'turn-' || conv_id || '-' || turn, 'turn', text, NULL, role FROM conversations
        UNION ALL SELECT 'item-' || item_id, 'item', text, NULL, NULL FROM benchmark)"""
    label = f"CASE WHEN toxic = 1 THEN '{DEFAULT_LABEL}' ELSE '{NEGATIVE_LABEL}' END"
    return {
        "json_articles_tolerant": """SELECT doc_id, '/' || doc_id AS url,
            CAST(NULL AS VARCHAR) AS "fetchTime", CAST(NULL AS VARCHAR) AS time, source AS title,
            text AS content, lang AS label FROM documents WHERE lang <> 'fr'""",
        "json_articles_rejected": """SELECT doc_id, CAST(length(to_json(struct_pack(
            url := '/' || doc_id, title := source, content := text, label := lang))) - 3 AS INTEGER)
            AS n_chars FROM documents WHERE lang = 'fr'""",
        "docstore_all": f"SELECT _id, text, lang, source FROM {envelopes}",
        "docstore_metadata": f"SELECT _id, kind FROM {envelopes}",
        "view_by_kind": f"SELECT _id AS key, text, source FROM {envelopes} WHERE kind = 'turn'",
        "view_time_title": """SELECT o_orderkey AS id, o_orderdate AS key, o_orderpriority AS value FROM orders
            ORDER BY key, id""",
        "lookup_by_ids": """SELECT * FROM customer WHERE c_custkey IN
            (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
        "scan_filter_type": "SELECT * FROM events WHERE event_type = 'purchase'",
        "select_sort_limit": """SELECT p_partkey, p_name, p_brand FROM part
            ORDER BY p_name DESC, p_partkey LIMIT 10""",
        "rekey_project": "SELECT 'my_' || c_custkey AS _id, c_name AS name FROM customer",
        "saved_by_id": """SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END AS c_mktsegment, c_acctbal
            FROM customer""",
        "view_key_range": """SELECT o_orderdate, o_orderkey, o_orderpriority FROM orders
            WHERE o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1995-03-31'""",
        "inferred_documents": """SELECT event_id AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS BIGINT) AS size, CAST(NULL AS VARCHAR) AS url
            FROM events UNION ALL SELECT page_id, NULL, CAST(length(html) AS BIGINT), url FROM pages""",
        "page_frontier": f"""SELECT i AS page_index, '{BASE_URL}' || i AS url
            FROM (SELECT unnest(range(0, n + 1, 20)) AS i FROM
              (SELECT count(*) AS n FROM pages) AS c) AS r""",
        "doccat_train_lines": f"""SELECT doc_id, {label} || ' ' ||
            trim(regexp_replace(text, '[ \\t\\r\\n]+', ' ', 'g'), ' ') AS value
            FROM documents JOIN labels USING (doc_id)""",
        "training_union": f"""SELECT doc_id, text, {label} AS label
            FROM documents JOIN labels USING (doc_id)""",
    }
