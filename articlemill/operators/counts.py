"""Word counts, topic dictionaries, and scores of documents against them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlemill.operators.lookup import MAX_BROADCAST_ROWS, keyed_join
from articlemill.sources.tables import by_document

MAX_INLINE_WORDS = 10_000


def exploded_tokens(docs: DataFrame, token_array: Column, *keep: str) -> DataFrame:
    """Rows `(keep..., word)` without the empty tokens."""
    return docs.select(*keep, F.explode(token_array).alias("word")).filter("word <> ''")


def drop_words(
    df: DataFrame, words: Iterable[str] | DataFrame | None, column: str = "word"
) -> DataFrame:
    """Removes listed words: a hashed IN test for a short list, an anti join for a long one or a table.

    Tables of tokens hold frequent words very often; count them before dropping a long list.
    """
    if words is None:
        return df
    if isinstance(words, DataFrame):
        listed = words.select(F.col(words.columns[0]).alias(column)).distinct()
        return keyed_join(df, listed, [column], "left_anti")
    listed = sorted(set(words))
    if len(listed) > MAX_INLINE_WORDS:
        table = df.sparkSession.createDataFrame([(w,) for w in listed], f"{column} string")
        return keyed_join(df, table, [column], "left_anti", bound=len(listed))
    return df.filter(~F.col(column).isin(listed))


def word_counts(
    docs: DataFrame, token_array: Column, stopwords: Iterable[str] | DataFrame | None = None
) -> DataFrame:
    """Rows `(word, cnt)`. Each task counts its own tokens before the one shuffle.

    Stopwords given as a table or a long list are dropped from the counts, where each word
    is one row; those of a short list are dropped from the tokens, which spares counting them.
    """
    words = exploded_tokens(docs, token_array)
    if stopwords is not None and not isinstance(stopwords, DataFrame):
        stopwords = list(stopwords)
    late = isinstance(stopwords, DataFrame) or (stopwords is not None and len(stopwords) > MAX_INLINE_WORDS)
    if not late:
        words = drop_words(words, stopwords)
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    return drop_words(counts, stopwords) if late else counts


def top_words(
    docs: DataFrame,
    token_array: Column,
    n: int,
    stopwords: Iterable[str] | DataFrame | None = None,
) -> DataFrame:
    """The topic dictionary: the `n` most frequent words, ties in word order."""
    return word_counts(docs, token_array, stopwords).orderBy(F.desc("cnt"), "word").limit(n)


def nth_word(counts: DataFrame, n: int) -> DataFrame:
    """The word at rank `n`, counted from 0; no row if there are fewer words."""
    return counts.orderBy(F.desc("cnt"), "word").offset(n).limit(1)


def document_counts(docs: DataFrame, key: str, token_array: Column) -> DataFrame:
    """Rows `(key, counts)` with the counts of each document as one array."""
    # Placed by key, a document needs no shuffle for either grouping.
    words = exploded_tokens(by_document(docs, key), token_array, key)
    counted = words.groupBy(key, "word").agg(F.count(F.lit(1)).alias("cnt"))
    pairs = F.sort_array(F.collect_list(F.struct("word", "cnt")))
    return counted.groupBy(key).agg(pairs.alias("counts"))


def merge_counts(documents: DataFrame, counts: str = "counts") -> DataFrame:
    """Sums the count arrays of all documents by word."""
    pairs = documents.select(F.explode(counts).alias("pair")).select("pair.word", "pair.cnt")
    return pairs.groupBy("word").agg(F.sum("cnt").alias("cnt"))


def dictionary_scores(
    docs: DataFrame,
    keys: list[str],
    token_array: Column,
    dictionary: DataFrame,
    bound: int | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Rows `(keys, n_tokens, n_matched, score)`; the score is the matched share.

    Documents without tokens score 0. `bound` is the largest size of the dictionary, if
    it is known. A dictionary that is not known to be small is joined with the words of each
    document counted first, so that a repeated word is shuffled once per document.
    """
    listed = dictionary.select("word").distinct().withColumn("_hit", F.lit(1))
    if bound is not None and bound <= max_rows:
        words = docs.select(*keys, F.explode_outer(token_array).alias("word"), F.lit(1).alias("_n"))
        marked = words.join(F.broadcast(listed), "word", "left")
    else:
        placed = by_document(docs, *keys).select(*keys, F.explode_outer(token_array).alias("word"))
        words = placed.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("_n"))
        marked = keyed_join(words, listed, ["word"], "left")
    is_token = F.col("word").isNotNull() & (F.col("word") != "")
    totals = marked.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(is_token, F.col("_n"))), F.lit(0)).cast("bigint").alias("n_tokens"),
        F.coalesce(F.sum(F.when(is_token, F.col("_n") * F.col("_hit"))), F.lit(0))
        .cast("bigint")
        .alias("n_matched"),
    )
    share = F.when(F.col("n_tokens") > 0, F.col("n_matched") / F.col("n_tokens")).otherwise(0.0)
    return totals.withColumn("score", share)


def labelled_dictionary(
    docs: DataFrame,
    labels: DataFrame,
    key: str,
    token_array: Column,
    n: int,
    stopwords: Iterable[str] | DataFrame | None = None,
) -> DataFrame:
    """Topic dictionary of the documents that the labels name."""
    named = docs.join(labels.select(key), key, "left_semi")
    return top_words(named, token_array, n, stopwords)


def ngram_counts(docs: DataFrame, token_array: Column, n: int) -> DataFrame:
    """Counts of runs of `n` tokens `(gram, cnt)`; no run crosses a document's end."""
    listed = docs.select(token_array.alias("_tokens"))
    # Shifted copies of the array put each token beside those that follow it.
    shifts = [F.slice("_tokens", F.lit(i + 1), F.size("_tokens")).alias(f"t{i}") for i in range(n)]
    runs = listed.select(F.explode(F.arrays_zip(*shifts)).alias("run"))
    words = [F.col(f"run.t{i}") for i in range(n)]
    grams = runs.filter(words[-1].isNotNull()).select(F.concat_ws(" ", *words).alias("gram"))
    return grams.groupBy("gram").agg(F.count(F.lit(1)).alias("cnt"))

