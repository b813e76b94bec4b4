"""Patterns of relations, learned from pairs that are known to be related.

What stands between two mentions is their context, with the types of both. Contexts in which known pairs occur become patterns, pairs that occur in
patterns become known, and so on until nothing is new. A pattern is trusted by its share: of the pairs in its context whose left side is
known for the relation, how many are known pairs. Contexts that do not reach a share, or too few known pairs, are cut, so wrong ones do not spread.

Each round is two joins on a table of distinct pairs and contexts, on the left side and on the context; no pairs of rows of a group are made.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articlemill.sources.scratch import written

CONTEXT = ["left_type", "between", "right_type"]
PAIR = ["left_text", "right_text"]
ROUNDS, SUPPORT, CONFIDENCE = 10, 2, 0.5


@dataclass(frozen=True)
class LearnedRelations:
    """`relations`: `(left_text, right_text, rel_type, confidence)`; `patterns`: `(left_type, between, right_type, rel_type, support, confidence)`."""

    relations: DataFrame
    patterns: DataFrame
    rounds: int


def occurrences(pairs: DataFrame) -> DataFrame:
    """The distinct pairs of names and contexts among the rows of `relations.relation_pairs`."""
    return pairs.select(*PAIR, *CONTEXT).na.drop().distinct()


def scored_patterns(occurring: DataFrame, known: DataFrame, support: int, confidence: float) -> DataFrame:
    """Contexts with at least `support` known pairs that make up at least `confidence` of the pairs whose left side is known."""
    lefts = known.select("left_text", "rel_type").distinct()
    candidates = occurring.join(lefts, "left_text")
    marked = candidates.join(known.select(*PAIR, "rel_type", F.lit(1).alias("_known")), [*PAIR, "rel_type"], "left")
    scored = marked.groupBy(*CONTEXT, "rel_type").agg(F.count("_known").alias("support"), F.count(F.lit(1)).alias("_all"))
    share = F.col("support") / F.col("_all")
    return scored.filter((F.col("support") >= support) & (share >= confidence)).select(*CONTEXT, "rel_type", "support", share.alias("confidence"))


def found_pairs(occurring: DataFrame, patterns: DataFrame) -> DataFrame:
    """The pairs that occur in patterns, each with the confidence of its best one."""
    met = occurring.join(patterns, CONTEXT)
    return met.groupBy(*PAIR, "rel_type").agg(F.max("confidence").alias("confidence"))


def learn_relations(pairs: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confidence: float = CONFIDENCE) -> LearnedRelations:
    """Learns from seeds `(left_text, right_text, rel_type)` over rows of `relations.relation_pairs`.

    Seeds stay known with confidence 1, whether or not they occur; rows with nulls are left out of either side. Stops after `rounds` rounds or once no
    pair is new; the patterns are those of the last round. The same rows give the same result. Without seeds nothing is learned.
    """
    occurring = written(occurrences(pairs), "occurrences")
    known = written(seeds.select(*PAIR, "rel_type").na.drop().distinct().withColumn("confidence", F.lit(1.0)), "known")
    count, done = known.count(), 0
    patterns = scored_patterns(occurring, known, support, confidence)
    for done in range(1, rounds + 1):
        patterns = written(scored_patterns(occurring, known, support, confidence), "patterns")
        both = known.unionByName(found_pairs(occurring, patterns))
        known = written(both.groupBy(*PAIR, "rel_type").agg(F.max("confidence").alias("confidence")), "known")
        before, count = count, known.count()
        if count == before:
            break
    return LearnedRelations(known, patterns, done)
