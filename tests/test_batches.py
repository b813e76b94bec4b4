import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from articlemill.functions.text import word_tokens
from articlemill.operators import batches, learned_tokens, sentence_ends


def test_slices_of_a_batch():
    texts = ["a" * 10, None, "b" * 100, "", "c" * 10, "d" * 10]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], ["i", "text"])
    parts = list(batches.sliced(batch, 1, 20))
    assert [p.column(0).to_pylist() for p in parts] == [[0, 1], [2], [3, 4], [5]]
    assert list(batches.sliced(batch.slice(0, 0), 1)) == []
    assert [p.column(1).to_pylist() for p in batches.sliced(batch.slice(4), 1, 1)] == [["c" * 10], ["d" * 10]]


@pytest.mark.parametrize("size", [1, 40, 1 << 21])
def test_pieces_change_nothing(spark, monkeypatch, size):
    monkeypatch.setattr(batches.sliced, "__defaults__", (size,))
    texts = ["He met Mr. Lee. They left", None, "", "One! Two? 3.5 a,b", " ", "No end here"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    model = sentence_ends.EndModel(frozenset(["mr"]), frozenset(["they"]))
    found = [(r.doc_id, r.sent_id, r.text) for r in sentence_ends.learned_sentences(docs, ["doc_id"], "text", model).collect()]
    each = {0: ["He met Mr. Lee.", "They left"], 3: ["One!", "Two?", "3.5 a,b"], 5: ["No end here"]}
    assert sorted(found) == [(i, k, s) for i in range(18) for k, s in enumerate(each.get(i % 6, []))]
    counted = learned_tokens.split_counts(docs, "text", word_tokens(F.col("text"))).agg(F.sum("n"), F.sum("n_split")).first()
    inner = sum(len(w) - 1 for t in texts if t for w in t.split())
    assert counted[0] == inner and counted[1] == 3 * 8  # one before each of four marks at an end, two in "3.5" and two in "a,b"
