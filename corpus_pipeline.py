"""From raw documents to token ids, stage by stage.

Each stage takes the documents that the one before it kept and returns those that it keeps, with
the columns of `documents`; the last returns token ids. The stages are the operators of
`articlemill.llm`; every stage is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articlemill.llm import bpe, decontamination, line_dedup, minhash, quality_classifier
from articlemill.llm.common import id_part, ready, stored
from articlemill.llm.queries import tokenizer_path
from articlemill.llm.text_stats import with_statistics
from articlemill.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.5 or more go on. Learns as `op4` does."""
    labels = read_table(ready(spark), sf_dir, "labels").select("doc_id", "quality")
    stats = stored(with_statistics(docs.select("doc_id", "text")).select("doc_id", "stats"), "statistics")
    model = quality_classifier.fit(stats.filter(id_part("doc_id", 3) != 1).join(labels, "doc_id"))
    return quality_classifier.accepted(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier, equal or one edit away, go; so do documents left without a line. `n_chars` follows."""
    ready(spark)
    kept = line_dedup.without_repeated_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity 0.8."""
    ready(spark)
    return minhash.without_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontamination.without_contaminated(docs, read_table(ready(spark), sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`(doc_id, n_tokens, ids_sha256, decoded_sha256, ids)` of every document."""
    ready(spark)
    return bpe.round_trip_digests(docs, tokenizer_path(), with_ids=True)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("bpe", encode),
]

#: A fitted classifier decides which rows there are, so no SQL gives them. No test holds the rows of the stages against brute force; tests/llm does so for three of their operators alone.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}


def oracles() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
