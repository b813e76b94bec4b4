import hashlib
import math
import os
import random

import duckdb
import numpy as np
import pytest

from articlemill.llm import centroid_clustering as clustering
from articlemill.llm import common, oracles, queries

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, width, count, rounds, scale=256, seed="2:"):
    """`(key, cluster, distance, cluster's, all, digest)` of each kept row, by whole distances in Python's integers."""
    kept = [(k, tuple(math.floor(scale * float(np.float32(v))) for v in x)) for k, x in rows
            if x is not None and len(x) == width and all(v is not None and math.isfinite(v) for v in x)]
    first = sorted((hashlib.sha256((seed + ("" if k is None else str(k))).encode()).hexdigest(), x) for k, x in kept)[:count]
    centroids = [x for _, x in first]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(centroids)) for _, x in kept]

    for _ in range(rounds):
        groups = {}
        for (_, x), (_, k) in zip(kept, assign(), strict=True):
            groups.setdefault(k, []).append(x)
        centroids = [tuple(sum(v) // len(groups[k]) for v in zip(*groups[k], strict=True)) if k in groups else c for k, c in enumerate(centroids)]
    found = assign()
    each = {}
    for d, k in found:
        each[k] = each.get(k, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((k, c, d, each[c], sum(each.values()), digest[c]) for (k, _), (d, c) in zip(kept, found, strict=True)), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def vectors(spark, rows, schema="vec_id bigint, embedding array<float>"):
    return spark.createDataFrame(rows, schema).repartition(3)


def odd_rows():
    draw = random.Random(8)
    rows = [(i % 60, [draw.gauss(0, 1) for _ in range(4)]) for i in range(150)]
    rows += [(k, [0.5, -0.25, 0.0, 1.0]) for k in range(100, 180)]  # a third are copies
    rows += [(200, None), (201, []), (202, [1.0, 2.0, 3.0]), (203, [1.0, None, 0.0, 0.0]), (204, [float("nan")] * 4)]
    return [*rows, (205, [float("inf"), 0.0, 0.0, 0.0]), (None, [0.1, 0.2, 0.3, 0.4]), (206, [-1000.0, 2000.5, 0.0, 1e5])]


@pytest.mark.parametrize("count", [1, 7, 40, 400])
def test_clusters_agree_with_brute_force(spark, count):
    rows = odd_rows()
    df = vectors(spark, rows).selectExpr("*", "1 AS x", "2 AS key", "3 AS cluster", "4 AS distance")
    found = clustering.cluster_report(df, width=4, count=count)
    assert result(found) == brute(rows, 4, count, 5)


def test_products_stay_exact_beyond_floats(spark):
    draw = random.Random(9)
    rows = [(i, [float(draw.randint(-(1 << 18), 1 << 18)) for _ in range(3)]) for i in range(60)]
    assert result(clustering.cluster_report(vectors(spark, rows), width=3, count=5)) == brute(rows, 3, 5, 5)
    x, change = np.array([[1 << 27, -(1 << 27), 3]]), np.array([(1 << 27) + 1, 5, -7])
    assert clustering.product(x, change).tolist() == [int(sum(a * b for a, b in zip(x[0].tolist(), change.tolist(), strict=True)))]


def test_no_vectors_and_vectors_too_large(spark):
    for rows in ([], [(1, [1.0])], [(1, [1e30, 0.0])]):
        assert result(clustering.cluster_report(vectors(spark, rows), width=2, count=3)) == []
    only = [(1, [0.5, 0.5]), (1, [0.5, 0.5])]
    assert result(clustering.cluster_report(vectors(spark, only), width=2, count=3)) == brute(only, 2, 3, 5)


def test_a_round_updates_only_what_moved_and_drops_the_last_table(spark):
    before = np.array([[1, 2, 3], [4, 5, 6]])
    after = np.array([[1, 2, 3], [4, 0, 6]])
    rows = spark.createDataFrame([(1, [1, 1, 1], [6, 15]), (2, [2, 0, 1], [100, 14])], "key bigint, x array<int>, dots array<bigint>")
    state = common.stored(rows, "products")
    changed = common.stored(clustering.updated(state, before, after), "products")
    folder = os.path.dirname(state.inputFiles()[0].removeprefix("file://"))
    common.discarded(state)
    assert not os.path.exists(folder)
    # The wrong 100 stays, as its centroid did.
    assert {r.key: r.dots for r in changed.collect()} == {1: [6, 10], 2: [100, 14]}


def test_the_query_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    found = queries.op12_centroid_clustering(spark, folder)
    expected = con.execute(oracles.op12())
    names = [d[0] for d in expected.description]
    assert result(found.select(*names)) == sorted(expected.fetchall(), key=repr)
