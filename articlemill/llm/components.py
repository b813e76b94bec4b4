"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articlemill.llm.common import stored


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges `(a, b)` with a > b: hangs neighbours of each node on the least of them.

    The large step moves the neighbours above a node, the small step those below it and the node.
    The least neighbour is a grouped minimum, combined before its shuffle. It is stored before it
    goes back to the edges: only a join of two sides that are shuffled for it can be split by
    adaptive execution, which a node with very many neighbours needs.
    """
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        moved = both.join(stored(least, "least"), "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        least = stored(edges.groupBy("a").agg(F.min("b").alias("low")), "least")
        joined = edges.join(least, "a")
        moved = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).union(least.select("a", F.col("low").alias("b")))
    return moved.filter("a > b").distinct()


def state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def components(edges: DataFrame) -> DataFrame:
    """`(node, component)` of every node of the edges `(a, b)`; a component's id is its least node.

    Alternates large and small star steps, each stored, until nothing changes: a number of
    rounds that grows with the logarithm of the longest path. Loops and null ends are ignored.
    """
    ordered = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = stored(ordered, "edges")
    before = state(current)
    while before[0]:
        current = stored(star(star(current, True), False), "edges")
        now = state(current)
        if now == before:
            break
        before = now
    tops = current.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(tops.distinct())
