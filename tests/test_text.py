import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from articlemill.functions import text as X
from articlemill.functions.stopwords import (
    SHORT_STOPWORDS, english_stopwords, stopword_table, with_stripped_forms,
)
from articlemill.operators import counts as C
from articlemill.operators import spans as S
from articlemill.plans.articles import topic_dictionary

TEXTS = [
    "", "... !!", "  lead and trail  ", "one\ntwo", "well-known", "für Élan", "don't stop",
    "Room 101 is 1st",
]


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def tokens_of(spark, texts, array):
    rows = docs_of(spark, texts).select("doc_id", array.alias("t")).orderBy("doc_id").collect()
    return [r["t"] for r in rows]


def test_letters_only_tokens(spark):
    assert tokens_of(spark, TEXTS, X.tokens(F.col("text"))) == [
        [], [], ["lead", "and", "trail"], ["onetwo"], ["wellknown"], ["fr", "lan"],
        ["dont", "stop"], ["room", "is", "st"],
    ]


def test_separator_keeps_words_apart(spark):
    assert tokens_of(spark, ["one\ntwo", "a-b c"], X.tokens(F.col("text"), separator=" ")) == [
        ["one", "two"], ["a", "b", "c"],
    ]


def test_letters_and_digits(spark):
    array = X.tokens(F.col("text"), X.LETTERS_DIGITS)
    assert tokens_of(spark, ["Room 101, B-2"], array) == [["room", "101", "b2"]]


def test_unique_keeps_first_order(spark):
    array = F.array_distinct(X.without_words(X.tokens(F.col("text")), ["the"]))
    assert tokens_of(spark, ["b the a b the a c"], array) == [["b", "a", "c"]]


def test_stopwords_keep_order_and_repeats(spark):
    array = X.without_words(X.tokens(F.col("text")), SHORT_STOPWORDS)
    assert tokens_of(spark, ["The dog and the dog"], array) == [["dog", "dog"]]


def test_word_tokens_keep_case_and_marks(spark):
    array = X.without_words_any_case(X.word_tokens(F.col("text")), SHORT_STOPWORDS)
    assert tokens_of(spark, ["The Dog, and THE end."], array) == [["Dog", ",", "end", "."]]


def test_stopword_lists(spark):
    assert len(SHORT_STOPWORDS) == 33
    assert "the" in english_stopwords()
    assert "dont" in with_stripped_forms(["don't"])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab Z9.\n-é'", max_size=30), min_size=1, max_size=8))
def test_tokens_agree_with_deletion(spark, texts):
    got = tokens_of(spark, texts, X.tokens(F.col("text")))
    wanted = [[t for t in re.sub("[^A-Za-z ]+", "", x).lower().split(" ") if t] for x in texts]
    assert got == wanted


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab Z9.!\n\té😀", max_size=30), min_size=1, max_size=8))
def test_spans_cover_their_text(spark, texts):
    docs = docs_of(spark, texts)
    for spans, pattern in [
        (S.token_spans(docs, ["doc_id"], "text"), X.NON_SPACE),
        (S.sentence_spans(docs, ["doc_id"], "text"), X.SENTENCE),
    ]:
        got = sorted((r["doc_id"], r["begin"], r["end"], r["text"]) for r in spans.collect())
        wanted = sorted(
            (i, m.start(), m.end(), m.group())
            for i, text in enumerate(texts)
            for m in re.finditer(pattern, text)
        )
        assert got == wanted


def test_covered_text_and_slices(spark):
    row = docs_of(spark, ["San Antonio, TX"]).select(
        X.covered_text(F.col("text"), F.lit(4), F.lit(11)).alias("a"),
        X.slice_joined(X.word_tokens(F.col("text")), 0, 2).alias("b"),
        X.first_chars(F.col("text"), 3).alias("c"),
        X.last_chars_reversed(F.col("text"), 2).alias("d"),
        X.squeeze(F.lit("  a \n b ")).alias("e"),
        X.base64_pair(F.lit("user"), F.lit("secret")).alias("f"),
    ).head()
    assert tuple(row) == ("Antonio", "San Antonio", "San", "XT", "a b", "dXNlcjpzZWNyZXQ=")



@pytest.fixture
def corpus(spark):
    return docs_of(spark, ["b a a", "", "the a c b", "d"])


def test_counts_and_ties(spark, corpus):
    array = X.raw_tokens(F.col("text"))
    counts = {r["word"]: r["cnt"] for r in C.word_counts(corpus, array).collect()}
    assert counts == {"a": 3, "b": 2, "c": 1, "d": 1, "the": 1}
    top = [tuple(r) for r in C.top_words(corpus, array, 3, ["the"]).collect()]
    assert top == [("a", 3), ("b", 2), ("c", 1)]
    assert C.top_words(corpus, array, 50, ["the"]).count() == 4


def test_stopwords_as_table_or_list(spark, corpus):
    array = X.raw_tokens(F.col("text"))
    by_list = C.word_counts(corpus, array, ["the", "a"]).collect()
    by_table = C.word_counts(corpus, array, stopword_table(spark, ["the", "a"])).collect()
    assert sorted(by_list) == sorted(by_table)


def test_nth_word(spark, corpus):
    counts = C.word_counts(corpus, X.raw_tokens(F.col("text")))
    assert C.nth_word(counts, 1).head()["word"] == "b"
    assert C.nth_word(counts, 5).count() == 0


def test_merge_counts_example(spark):
    pairs = "title string, counts array<struct<word:string,cnt:bigint>>"
    articles = spark.createDataFrame(
        [
            ("title1", [("a", 10), ("b", 5), ("c", 20)]),
            ("title2", [("a", 10), ("c", 20)]),
            ("title3", [("b", 5), ("c", 20)]),
        ],
        pairs,
    )
    assert {r["word"]: r["cnt"] for r in C.merge_counts(articles).collect()} == {"a": 20, "b": 10, "c": 60}


def test_document_counts(spark, corpus):
    rows = C.document_counts(corpus, "doc_id", X.raw_tokens(F.col("text"))).collect()
    assert {r["doc_id"]: [tuple(p) for p in r["counts"]] for r in rows}[0] == [("a", 2), ("b", 1)]


def test_ngrams_stay_in_their_document(spark):
    docs = docs_of(spark, ["a b c", "b c", "c"])
    rows = C.ngram_counts(docs, X.tokens(F.col("text")), 2).collect()
    assert {r["gram"]: r["cnt"] for r in rows} == {"a b": 1, "b c": 2}


@pytest.mark.parametrize("max_rows", [100, 1])
def test_dictionary_scores(spark, corpus, max_rows):
    words = spark.createDataFrame([("a",), ("b",)], "word string")
    array = X.raw_tokens(F.col("text"))
    rows = C.dictionary_scores(corpus, ["doc_id"], array, words, max_rows=max_rows).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["n_matched"]) for r in rows} == {
        0: (3, 3), 1: (0, 0), 2: (4, 2), 3: (1, 0),
    }


def test_topic_dictionary_skips_unreadable_files(spark):
    files = spark.createDataFrame(
        [("f1", '{"content":"Fraud and fraud"}'), ("f2", "no json"), ("f3", "")], "path string, value string"
    )
    rows = topic_dictionary(files, 10, SHORT_STOPWORDS).collect()
    assert [tuple(r) for r in rows] == [("fraud", 2)]
