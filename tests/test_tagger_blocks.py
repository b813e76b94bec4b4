from pyspark.sql import functions as F

from articlemill.operators import tagger as G


def test_shapes_of_ascii_tokens(spark):
    words = ["Ann", "McDonald", "ABC", "a", "12a", "..", "x1y2", "A", "abcde", "ABCDE1", "Zz9-_", "$", "hello"]
    found = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string").select("i", G.shape(F.col("w")).alias("s"))
    assert {words[r.i]: r.s for r in found.collect()} == {w: G.ascii_shape(w) for w in words}
    other = spark.createDataFrame([(["Ann", "été", "中"],)], "w array<string>").select(G.other_shapes(F.col("w"))).first()[0]
    assert other == [None, " a", " a"]


def test_sentences_of_like_length_share_a_block(monkeypatch):
    monkeypatch.setattr(G, "PIECE", 2000)
    model = G.model_of([], [("P", "a", 1)])
    rows = [G.np.zeros(n, G.np.int64) for n in [1, 1000, 0, 2] * 100]
    found = list(G.blocks(rows, model))
    assert sorted(i for some, _ in found for i in some) == [i for i in range(400) if i % 4 != 2]
    assert all([len(rows[i]) for i in some] == block.sizes.tolist() for some, block in found)
    assert sum(block.words.size for _, block in found) < 1.01 * sum(map(len, rows)) + 2000
