"""Centroid clustering of integer vectors by an incremental matrix of dot products.

For a vector x and a centroid c the squared distance is |x|^2 - 2 x.c + |c|^2. The table of vectors carries, per
vector, its exact integer dot products with all centroids. When centroids move, a product changes by
the sum of x_j (c'_j - c_j) over the components j that moved, so an update reads only those; a centroid that stays costs
nothing. Nearest centroids then follow from the products alone, ties by the smaller number.

Each round writes the table with its new products below the shared folder and removes the one before it, so that a lost
executor costs a read of the last round. What crosses the network in a round is, per task, a sum for each centroid
and component that has any; the driver holds the centroids only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articlemill.llm.common import discarded, extended, stored

#: Components are kept up to this size, so that squared distances of 64 components fit 64 bits.
LARGEST = 1 << 27
#: Sums that a float holds exactly.
EXACT_FLOAT = 1 << 53


def integer_vectors(df: DataFrame, key: str, vector: str, width: int, scale: int) -> DataFrame:
    """`(key, x)`: the vectors with `width` components, none null or not finite, as floor(scale * component).

    Vectors with a component beyond LARGEST after scaling are left out as well, since distances would not fit a long.
    """
    x = F.col(f"`{vector}`")
    scaled = F.transform(x, lambda v: F.floor(v.cast("double") * scale))
    fits = F.forall(x, lambda v: F.abs(v.cast("double")) * scale < LARGEST)  # false or null for NaN, infinity and null
    kept = df.filter((F.size(x) == width) & F.coalesce(fits, F.lit(False)))
    return kept.select(F.col(f"`{key}`").alias("key"), F.transform(scaled, lambda v: v.cast("int")).alias("x"))


def first_centroids(vectors: DataFrame, count: int, seed: str) -> np.ndarray:
    """The vectors with the least sha256 of the seed and their key, in that order; equal hashes go by components."""
    hashed = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    rows = vectors.select(hashed.alias("hash"), "x").orderBy("hash", "x").limit(count).collect()
    return np.array([r.x for r in rows], np.int64)


def matrix_of(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def listed(matrix: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    rows, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(matrix.ravel(), kind))


def product(x: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Exact integer products of rows with a vector: by floats where every partial sum is exact in them."""
    most = int(np.abs(x).max(initial=0)) * int(np.abs(change).max(initial=0)) * len(change)
    if most < EXACT_FLOAT:
        return (x.astype(np.float64) @ change.astype(np.float64)).astype(np.int64)
    return x.astype(np.int64) @ change


def updated(state: DataFrame, before: np.ndarray, after: np.ndarray) -> DataFrame:
    """The table with products for the moved centroids."""
    change = after - before
    moved = [(k, np.flatnonzero(c)) for k, c in enumerate(change) if c.any()]
    count, width = change.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, x, dots = batch.columns
            rows, products = matrix_of(x, width), matrix_of(dots, count).copy()
            for k, at in moved:
                products[:, k] += product(rows[:, at], change[k, at])
            yield pa.RecordBatch.from_arrays([key, x, listed(products, pa.int64())], batch.schema.names)

    return state.mapInArrow(run, state.schema)


def nearest(x: np.ndarray, dots: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector and the squared distance to it."""
    wide = x.astype(np.int64)
    distances = (wide * wide).sum(axis=1)[:, None] - 2 * dots + lengths
    best = distances.argmin(axis=1)  # the first of equal ones
    return best, distances[np.arange(len(best)), best]


def cluster_sums(state: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members of each cluster and the exact sums of their components."""
    count, width = centroids.shape
    lengths = (centroids * centroids).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((count, width + 1), np.int64)
        for batch in batches:
            x = matrix_of(batch.column(0), width)
            best, _ = nearest(x, matrix_of(batch.column(1), count), lengths)
            order = np.argsort(best, kind="stable")
            found, first = np.unique(best[order], return_index=True)
            if len(found):
                sums[found, :width] += np.add.reduceat(x[order].astype(np.int64), first, axis=0)
                sums[:, width] += np.bincount(best, minlength=count)
        cluster, component = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (cluster, component, sums[cluster, component])], ["cluster", "component", "total"])

    parts = state.select("x", "dots").mapInArrow(run, "cluster bigint, component bigint, total bigint")
    table = parts.groupBy("cluster", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    sums = np.zeros((count, width + 1), object)
    for r in table:
        sums[r.cluster, r.component] = int(r.total)
    return sums[:, width], sums[:, :width]


def means(centroids: np.ndarray, members: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """The floors of the means; a centroid without members stays."""
    after = centroids.copy()
    for k, n in enumerate(members):
        if n:
            after[k] = [int(total) // int(n) for total in sums[k]]
    return after


def clusters(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", width: int = 64, scale: int = 256,
    count: int = 40, rounds: int = 5, seed: str = "2:",
) -> tuple[DataFrame, np.ndarray]:
    """`(key, cluster, distance)` of each kept vector after `rounds` rounds, and the centroids.

    Kept are vectors of `width` components, none null or not finite (or too large, see `integer_vectors`). With fewer than
    `count` of them each starts a centroid; with none the table is empty. Each row is a vector, so repeated rows count
    each time; null keys are keys. Further columns are ignored. Equal distances go to the smaller number.
    """
    vectors = integer_vectors(df, key, vector, width, scale)
    centroids = first_centroids(vectors, count, seed).reshape(-1, width)
    out = extended(vectors.select("key"), "cluster int, distance bigint")
    if not len(centroids):
        return df.sparkSession.createDataFrame([], out).withColumnsRenamed({"key": key}), centroids
    number = len(centroids)
    none = np.zeros_like(centroids)
    state = stored(updated(vectors.withColumn("dots", F.array_repeat(F.lit(0).cast("bigint"), number)), none, centroids), "products")
    for _ in range(rounds):
        after = means(centroids, *cluster_sums(state, centroids))
        if (after == centroids).all():
            break  # no later round would change anything
        ended, state = state, stored(updated(state, centroids, after), "products")
        discarded(ended)
        centroids = after
    lengths = (centroids * centroids).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, distance = nearest(matrix_of(batch.column(1), width), matrix_of(batch.column(2), number), lengths)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.int32()), pa.array(distance)], ["key", "cluster", "distance"])

    assigned = stored(state.mapInArrow(run, out), "clusters")
    discarded(state)
    return assigned.withColumnsRenamed({"key": key}), centroids


def cluster_report(df: DataFrame, key: str = "vec_id", **options) -> DataFrame:
    """`(key, cluster, distance, cluster_inertia, inertia, centroid_sha256)` of each kept vector. See `clusters`."""
    assigned, centroids = clusters(df, key, **options)
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    each = {r.cluster: r.inertia for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    rows = [(k, each[k], sum(each.values()), digests[k]) for k in sorted(each)]
    # At most a row per centroid.
    table = df.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster").select(f"`{key}`", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
