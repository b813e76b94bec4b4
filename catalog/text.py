"""Tokens, word counts and topic dictionaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from articlemill.functions import text as X
from articlemill.functions.stopwords import SHORT_STOPWORDS, english_stopwords, stopword_table
from articlemill.operators import counts as C
from articlemill.operators import learned_tokens as L
from articlemill.operators import sentence_ends, spans
from articlemill.operators.lookup import keyed_join
from articlemill.plans.articles import topic_dictionary_of_texts
from articlemill.sources.tables import by_document, read_table, spread
from articlemill.sources.textfiles import dictionary_line
from catalog.sql import (
    ALNUM, ALPHA, SENTENCE_RX, SPACE_RX, WORD_RX, english_list, short_list, spans_sql, token_rows,
)

TOP = 1000
TOP_CASE = 2000


def documents(spark, sf):
    return read_table(spark, sf, "documents")


def spread_documents(spark, sf):
    return spread(documents(spark, sf).select("doc_id", "text"), "doc_id")


def top_words(spark, sf):
    return topic_dictionary_of_texts(
        documents(spark, sf), "doc_id", "text", TOP, english_stopwords()
    )


def case_counts(spark, sf):
    words = C.exploded_tokens(spread_documents(spark, sf), X.word_tokens(F.col("text")))
    kept = words.filter(~F.lower("word").isin(SHORT_STOPWORDS))
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def top_words_case_preserving(spark, sf):
    return case_counts(spark, sf).orderBy(F.desc("cnt"), "word").limit(TOP_CASE)


def nth_word(spark, sf):
    return C.nth_word(case_counts(spark, sf), TOP_CASE - 1)


def word_counts(spark, sf):
    return C.word_counts(spread_documents(spark, sf), X.raw_tokens(F.col("text")))


def positioned(spark, sf, array):
    return spread_documents(spark, sf).select("doc_id", F.posexplode(array).alias("pos", "token"))


def tokens_alpha(spark, sf):
    return positioned(spark, sf, X.tokens(F.col("text")))


def tokens_alnum(spark, sf):
    return positioned(spark, sf, X.tokens(F.col("text"), X.LETTERS_DIGITS))


def tokens_unique(spark, sf):
    kept = X.without_words(X.tokens(F.col("text"), X.LETTERS_DIGITS), english_stopwords())
    return positioned(spark, sf, F.array_distinct(kept))


def tokens_no_stop(spark, sf):
    stop = english_stopwords()
    table = stopword_table(spark, stop).withColumnRenamed("word", "token")
    return keyed_join(tokens_alpha(spark, sf), table, ["token"], "left_anti", bound=len(stop))


def tokens_case_preserving(spark, sf):
    kept = X.without_words_any_case(X.word_tokens(F.col("text")), SHORT_STOPWORDS)
    return positioned(spark, sf, kept)


def token_spans(spark, sf):
    return spans.token_spans(documents(spark, sf), ["doc_id"], "text")


def sentences(spark, sf):
    return spans.sentence_spans(documents(spark, sf), ["doc_id"], "text")


def token_slices(spark, sf):
    first = X.slice_joined(X.word_tokens(F.col("text")), 2, 6)
    return spread_documents(spark, sf).select("doc_id", first.alias("slice"))


def token_ngrams(spark, sf):
    # Most grams are rare, so a task's counts are as large as its texts: parts are bounded.
    docs = by_document(documents(spark, sf).select("doc_id", "text"), "doc_id")
    return C.ngram_counts(docs, X.tokens(F.col("text")), 3)


def words_per_doc(spark, sf):
    size = F.size(X.tokens(F.col("text"))).alias("n_words")
    return spread_documents(spark, sf).select("doc_id", size)


def article_count(spark, sf):
    return documents(spark, sf).agg(F.count(F.lit(1)).alias("n_articles"))


def merge_article_counts(spark, sf):
    per_document = C.document_counts(
        documents(spark, sf).select("doc_id", "text"), "doc_id", X.raw_tokens(F.col("text"))
    )
    return C.merge_counts(per_document)


def dictionary_lines(spark, sf):
    return top_words(spark, sf).select(dictionary_line(F.col("word"), F.col("cnt")).alias("value"))


def base64_pair(spark, sf):
    pair = X.base64_pair(F.col("c_name"), F.col("c_mktsegment"))
    return read_table(spark, sf, "customer").select("c_custkey", pair.alias("login"))


def text_edges(spark, sf):
    text = F.col("text")
    return documents(spark, sf).select(
        "doc_id",
        F.length(text).cast("bigint").alias("n"),
        X.first_chars(text, 10).alias("first_chars"),
        X.last_chars_reversed(text, 5).alias("last_chars"),
    )


def is_taught():
    """A tenth of the documents, by a seeded hash; the others are held out."""
    return F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(10)) == 0


def split_model(spark, sf):
    taught = documents(spark, sf).select("doc_id", "text").filter(is_taught())
    return L.fit_splits(taught, "text", X.word_tokens(F.col("text")))


def tokens_learned(spark, sf):
    """Learns from the rule tokeniser's tokens, then tokenises every document."""
    return L.learned_tokens(documents(spark, sf), ["doc_id"], "text", split_model(spark, sf))


def tokens_learned_agreement(spark, sf):
    held = documents(spark, sf).select("doc_id", "text").filter(~is_taught())
    return L.agreement(held, "text", X.word_tokens(F.col("text")), split_model(spark, sf))


def word_end_statistics(spark, sf):
    return sentence_ends.word_statistics(spread_documents(spark, sf), "text")


def sentences_learned(spark, sf):
    model = sentence_ends.fit_ends(word_end_statistics(spark, sf))
    return sentence_ends.learned_sentences(documents(spark, sf), ["doc_id"], "text", model)


QUERIES = {
    f.__name__: f
    for f in [
        top_words, top_words_case_preserving, nth_word, word_counts, tokens_alpha, tokens_alnum,
        tokens_unique, tokens_no_stop, tokens_case_preserving, token_spans, sentences,
        token_slices, token_ngrams, words_per_doc, article_count, merge_article_counts,
        dictionary_lines, base64_pair, text_edges,
        tokens_learned, tokens_learned_agreement, word_end_statistics, sentences_learned,
    ]
}


def oracles() -> dict[str, str]:
    alpha = token_rows(f"[t FOR t IN {ALPHA} IF t <> '']")
    alnum = token_rows(f"[t FOR t IN {ALNUM} IF t <> '']")
    words = token_rows(f"regexp_extract_all(text, '{WORD_RX}')")
    kept_words = token_rows(
        f"[t FOR t IN regexp_extract_all(text, '{WORD_RX}') IF lower(t) NOT IN {short_list()}]"
    )
    top = f"""SELECT token AS word, count(*) AS cnt FROM ({alpha})
        WHERE token NOT IN {english_list()} GROUP BY token ORDER BY cnt DESC, word LIMIT {TOP}"""
    case = f"""SELECT token AS word, count(*) AS cnt FROM ({words})
        WHERE lower(token) NOT IN {short_list()} GROUP BY token ORDER BY cnt DESC, word"""
    return {
        "top_words": top,
        "top_words_case_preserving": f"{case} LIMIT {TOP_CASE}",
        "nth_word": f"{case} LIMIT 1 OFFSET {TOP_CASE - 1}",
        "word_counts": f"SELECT token AS word, count(*) AS cnt FROM ({alpha}) GROUP BY token",
        "tokens_alpha": alpha,
        "tokens_alnum": alnum,
        "tokens_unique": f"""SELECT doc_id, token,
            CAST(row_number() OVER (PARTITION BY doc_id ORDER BY min(pos)) - 1 AS INTEGER) AS pos
            FROM ({alnum}) WHERE token NOT IN {english_list()} GROUP BY doc_id, token""",
        "tokens_no_stop": f"SELECT * FROM ({alpha}) WHERE token NOT IN {english_list()}",
        "tokens_case_preserving": kept_words,
        "token_spans": spans_sql("documents", ["doc_id"], "text", SPACE_RX),
        "sentences": spans_sql("documents", ["doc_id"], "text", SENTENCE_RX, "sent_id"),
        "token_slices": f"""SELECT doc_id,
            array_to_string(regexp_extract_all(text, '{WORD_RX}')[3:6], ' ') AS slice FROM documents""",
        "token_ngrams": f"""SELECT gram, count(*) AS cnt FROM (
            SELECT token || ' ' || lead(token, 1) OVER w || ' ' || lead(token, 2) OVER w AS gram
            FROM ({alpha}) WINDOW w AS (PARTITION BY doc_id ORDER BY pos)) t
            WHERE gram IS NOT NULL GROUP BY gram""",
        "words_per_doc": f"""SELECT doc_id, CAST(len([t FOR t IN {ALPHA} IF t <> '']) AS INTEGER)
            AS n_words FROM documents""",
        "article_count": "SELECT count(*) AS n_articles FROM documents",
        "merge_article_counts": f"""SELECT token AS word, count(*) AS cnt FROM ({alpha})
            GROUP BY token""",
        "dictionary_lines": f"SELECT '(' || word || ',' || cnt || ')' AS value FROM ({top})",
        "base64_pair": """SELECT c_custkey, base64(encode(c_name || ':' || c_mktsegment)) AS login
            FROM customer""",
        "word_end_statistics": """WITH h AS (SELECT unnest(regexp_extract_all(text, '[\\p{L}\\p{N}][\\p{L}\\p{N}.''-]*')) AS hit FROM documents),
            f AS (SELECT hit, rtrim(hit, '.''-') AS form FROM h),
            w AS (SELECT lower(form) AS word, count(*) AS n, count(*) FILTER (right(hit, 1) = '.' AND right(hit, 2) <> '..') AS k,
              count(*) FILTER (left(form, 1) = lower(left(form, 1))) AS low FROM f GROUP BY lower(form)),
            r AS (SELECT greatest(1e-9, least(1 - 1e-9, sum(k) / sum(n))) AS rate FROM w),
            s AS (SELECT *, length(word) - length(replace(word, '.', '')) AS inside FROM w, r)
            SELECT word, n, k AS n_period, low AS n_lower, CASE WHEN k > 0 THEN round(
              2 * (k * (ln(0.99) - ln(rate)) + (n - k) * (ln(0.01) - ln(1 - rate)))
              * exp(-(length(word) - inside)) * (inside + 1) * pow((length(word) - inside)::DOUBLE, (k - n)::DOUBLE), 6) + 0.0 END AS score FROM s""",
        "text_edges": """SELECT doc_id, length(text) AS n, left(text, 10) AS first_chars,
            reverse(right(text, 5)) AS last_chars FROM documents""",
    }
