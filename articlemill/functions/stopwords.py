"""Stoplists.

Long lists are parameters: pass a list, or a table from
`articlemill.sources.textfiles.read_stopwords`. Without one, Spark's own English list
is used.
"""

from __future__ import annotations

from functools import cache

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession

# The short English stoplist of the case-preserving tokenizer.
SHORT_STOPWORDS = [
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into",
    "is", "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then",
    "there", "these", "they", "this", "to", "was", "will", "with",
]


@cache
def english_stopwords() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def with_stripped_forms(words: list[str]) -> list[str]:
    """Adds the forms without apostrophe, which is how tokens of letters look."""
    return sorted({w for word in words for w in (word, word.replace("'", ""))})


def stopword_table(spark: SparkSession, words: list[str]) -> DataFrame:
    return spark.createDataFrame([(w,) for w in sorted(set(words))], "word string")
