"""Plain-text inputs and outputs: dictionaries, stopwords, training lines, frontier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from articlemill.functions.text import squeeze


def page_frontier(
    spark: SparkSession, base: str, last: int, step: int = 20, first: int = 0
) -> DataFrame:
    """Index-page addresses `base + n`, for n from `first` to `last` inclusive."""
    pages = spark.range(first, last + 1, step).withColumnRenamed("id", "page_index")
    return pages.withColumn("url", F.concat(F.lit(base), F.col("page_index").cast("string")))


def dictionary_line(word: Column, cnt: Column) -> Column:
    return F.concat(F.lit("("), word, F.lit(","), cnt.cast("string"), F.lit(")"))


def write_dictionary(counts: DataFrame, path: str, n: int) -> None:
    """`(word,count)` lines of the top `n` words, most frequent first, in one file of one task."""
    ordered = counts.orderBy(F.desc("cnt"), "word").limit(n).coalesce(1)
    ordered.select(dictionary_line(F.col("word"), F.col("cnt")).alias("value")).write.mode(
        "overwrite"
    ).text(path)


#: A line in brackets, parted at its last comma: a word may hold commas, marks or nothing.
DICTIONARY_LINE = r"^\((.*),([0-9]+)\)$"


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Rows `(word, cnt)` of the lines of a dictionary, whatever their words are made of."""
    lines = spark.read.text(path).filter(F.col("value").rlike(DICTIONARY_LINE))
    return lines.select(
        F.regexp_extract("value", DICTIONARY_LINE, 1).alias("word"),
        F.regexp_extract("value", DICTIONARY_LINE, 2).cast("bigint").alias("cnt"),
    )


def rejected_dictionary_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines `(value)` that are no entries."""
    return spark.read.text(path).filter(~F.col("value").rlike(DICTIONARY_LINE))


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """A stoplist file with one word per line."""
    return spark.read.text(path).select(F.trim("value").alias("word")).filter("word <> ''").distinct()


def training_line(label: Column, content: Column) -> Column:
    """`label content` on one line; line breaks inside the content become blanks."""
    return F.concat_ws(" ", label, squeeze(content))


def write_training_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    lines = df.select(training_line(F.col("label"), F.col("content")).alias("value"))
    lines.write.mode(mode).text(path)


def write_text(df: DataFrame, column: str, path: str, mode: str = "overwrite") -> None:
    df.select(F.col(column).alias("value")).write.mode(mode).text(path)
