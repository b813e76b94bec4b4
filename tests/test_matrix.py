import numpy as np
import pytest
from pyspark.sql import functions as F

from articlemill.operators import classify as K
from articlemill.operators import matrix as M
from articlemill.operators.lookup import keyed_join


def matrix_of(spark, array):
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(array)]
    return spark.createDataFrame(rows, "row_id bigint, features array<double>")


def dense(cells, shape):
    out = np.zeros(shape)
    for r in cells.collect():
        out[r["row_id"], r["col_id"]] = r["value"]
    return out


A = np.arange(21).reshape(7, 3) - 9.0
B = np.arange(15).reshape(3, 5) * 0.5


def test_access(spark):
    m = matrix_of(spark, A)
    assert tuple(M.shape(m).head()) == (7, 3)
    assert M.cell(m, 2, 1).head()["value"] == A[2, 1]
    assert sorted(r["row_id"] for r in M.get_rows(m, [0, 4, 99]).collect()) == [0, 4]
    cols = M.get_cols(m, [0, 2]).orderBy("row_id").collect()
    assert [r["col_2"] for r in cols] == list(A[:, 2])
    assert M.first_row(m).head()["features"] == list(A[0])


def test_transpose_in_blocks(spark):
    blocks = M.transpose(matrix_of(spark, A), block=4).orderBy("row_id", "block_id").collect()
    assert len(blocks) == 6
    assert blocks[0]["features"] == list(A[:4, 0]) and blocks[1]["features"] == list(A[4:, 0])
    assert np.array_equal(dense(M.transpose_cells(matrix_of(spark, A)), (3, 7)), A.T)


@pytest.mark.parametrize("broadcast_cells", [1000, 0])
def test_multiply(spark, broadcast_cells):
    product = M.multiply(matrix_of(spark, A), matrix_of(spark, B), block=2, broadcast_cells=broadcast_cells)
    assert product.count() == 35
    assert np.allclose(dense(product, (7, 5)), A @ B)


def test_multiply_checks_shapes(spark):
    with pytest.raises(ValueError, match="cannot multiply"):
        M.multiply(matrix_of(spark, A), matrix_of(spark, A))
    holes = spark.createDataFrame([(0, [1.0]), (2, [1.0])], "row_id bigint, features array<double>")
    ragged = spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0]), (2, [1.0])], "row_id bigint, features array<double>")
    twice = spark.createDataFrame([(0, [1.0]), (1, [1.0]), (1, [1.0])], "row_id bigint, features array<double>")
    for wrong in (holes, ragged, twice):
        with pytest.raises(ValueError, match="cannot multiply"):
            M.multiply(matrix_of(spark, A), wrong)


def test_plans_of_products_hold_no_index_arrays(spark):
    tall = spark.range(3_000_000).select(F.col("id").alias("row_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("features"))
    right = matrix_of(spark, np.ones((2, 3)))
    for cells in (1000, 0):
        plan = M.multiply(tall, right, broadcast_cells=cells)._jdf.queryExecution().optimizedPlan().toString()
        assert len(plan) < 6_000
        assert cells == 0 or "Join" not in plan


@pytest.mark.parametrize("rows_per_bucket", [7, 1_000_000])
def test_row_index(spark, rows_per_bucket):
    keys = [k * k - 50 for k in range(101)]
    df = spark.createDataFrame([(k, f"v{k}") for k in reversed(keys)], "k bigint, v string")
    rows = M.with_row_index(df, "k", rows_per_bucket=rows_per_bucket).orderBy("row_id").collect()
    assert [(r["row_id"], r["k"]) for r in rows] == list(enumerate(keys))


def test_row_index_numbers_rows_without_key_last(spark):
    df = spark.createDataFrame([(5, "a"), (None, "b"), (1, "c"), (None, "d")], "k bigint, v string")
    rows = M.with_row_index(df, "k").orderBy("row_id").collect()
    assert [(r["row_id"], r["k"]) for r in rows] == [(0, 1), (1, 5), (2, None), (3, None)]
    assert {r["v"] for r in rows[2:]} == {"b", "d"}
    assert M.with_row_index(df.limit(0), "k").count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_joins_agree_and_start_no_job(spark, how):
    big = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    small = spark.createDataFrame([(0, "hot"), (1, "one"), (999, "none")], "k bigint, name string")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    joined = [keyed_join(big, small, ["k"], how, bound=3), keyed_join(big, small, ["k"], how), keyed_join(big, small, ["k"], how, 3, 2)]
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before
    one, *others = (sorted(j.collect(), key=str) for j in joined)
    assert all(other == one for other in others)


def test_a_hot_key_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.shuffle.partitions": "40",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
        big = spark.range(60_000).repartition(8).select(F.sha2(F.col("id").cast("string"), 256).alias("text"), key.alias("k"))
        lookup = spark.range(60_000).select(F.col("id").alias("k"), F.lit("x").alias("name"))
        joined = keyed_join(big, lookup, ["k"])
        assert len(joined.collect()) == 60_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_dictionary_and_union(spark):
    docs = spark.createDataFrame(
        [(1, "bribe bribe fraud"), (2, "bribe today"), (3, "sun rain")], "doc_id bigint, text string"
    )
    labels = spark.createDataFrame([(1,)], "doc_id bigint")
    rows = K.classify_by_dictionary(docs, labels, "doc_id", F.split("text", " "), 2, 0.5).collect()
    assert {r["doc_id"]: r["label"] for r in rows} == {2: "corruption", 3: "noncorruption"}
    union = K.training_union(docs.filter("doc_id = 1"), docs.filter("doc_id = 3"))
    assert {r["doc_id"]: r["label"] for r in union.collect()} == {1: "corruption", 3: "noncorruption"}


def test_document_categoriser(spark):
    train = spark.createDataFrame(
        [(["bribe", "fraud"], 1.0), (["fraud"], 1.0), (["sun", "rain"], 0.0), (["rain"], 0.0)],
        "tokens array<string>, category double",
    )
    model = K.train_document_categoriser(train)
    docs = spark.createDataFrame(
        [(1, ["fraud", "new"]), (2, ["sun"]), (3, ["new"]), (4, [])], "doc_id bigint, tokens array<string>"
    )
    found = {r["doc_id"]: r for r in K.predict_categories(model, docs, ["doc_id"]).collect()}
    assert (found[1]["category"], found[2]["category"]) == (1, 0)
    # 4 words; class 1 has 3 tokens of which 2 are fraud, class 0 has none of it.
    likely, other = (2 + 1) / (3 + 4), (0 + 1) / (3 + 4)
    assert found[1]["prob"] == pytest.approx(likely / (likely + other))
    assert found[3]["prob"] == found[4]["prob"] == pytest.approx(0.5)


def test_categoriser_keeps_every_word(spark):
    """More distinct words than any vocabulary limit of old: each still tells its category."""
    n = 300_000
    words = F.transform(F.sequence(F.lit(0), F.lit(n // 2 - 1)), lambda i: F.concat(F.lit("w"), (i * 2 + F.col("id").cast("int")).cast("string")))
    train = spark.range(2).select(words.alias("tokens"), F.col("id").cast("double").alias("category"))
    model = K.train_document_categoriser(train)
    assert model.words.count() == n
    docs = spark.range(0, n, 29_999).select(F.col("id").alias("doc_id"), F.array(F.concat(F.lit("w"), F.col("id").cast("string"))).alias("tokens"))
    for r in K.predict_categories(model, docs, ["doc_id"]).collect():
        assert r["category"] == r["doc_id"] % 2 and r["prob"] > 0.6


def test_multinomial_learns_classes(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(150):
        label = i % 3
        center = [4.0 * (label == 0), 4.0 * (label == 1), 4.0 * (label == 2)]
        rows.append((i, [float(v) for v in rng.normal(center, 1.0)], label))
    df = spark.createDataFrame(rows, "row_id bigint, features array<double>, label int")
    found = K.predict_multinomial(K.train_multinomial(df, "label"), df, ["row_id", "label"])
    assert found.filter("category = label").count() >= 140
