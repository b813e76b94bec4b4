import math
import unicodedata

import pytest
from pyspark.sql import functions as F

from articlemill.functions.text import word_tokens
from articlemill.operators import learned_tokens as L

TEXTS = {
    1: "Plain words, and (more) of them: a.b 3.5 x-y!",
    2: "it's don't... no?! Ünï-cödé 你好, wörld 12:30",
    3: "", 4: None, 5: " \n\t ", 6: "one", 7: "été   \U0001f600\U0001f600 a,b,,c",
    8: "tail\n", 9: "1,000.00 $5 a@b.cd 10.0.0.1 ## --",
}


def frame(spark, texts=TEXTS):
    rows = [(k, t, "x") for k, t in texts.items()]
    return spark.createDataFrame(rows, "doc_id int, text string, token string").repartition(3)


def classes(c):
    if c in " \t\r\n":
        return 0, 0
    if c in L.ASCII_MARKS:
        return L.FIRST_MARK + L.ASCII_MARKS.index(c), L.FIRST_MARK
    kind = L.KINDS.get(unicodedata.category(c), L.OTHER)
    return kind, kind


def plain_contexts(text):
    """Of each boundary: its place and six features, by reading the text."""
    padded = "  " + text + "  "
    for i in range(1, len(text)):
        around = [classes(c) for c in padded[i : i + 4]]
        if around[1][0] and around[2][0]:
            left, right = around[1][0], around[2][0]
            yield i, [("pair", left, right), ("left", left), ("right", right), ("before", around[0][1], left, right),
                      ("after", left, right, around[3][1]), ("same", text[i - 1] == text[i])]


def plain_fit(texts, starts, rounds):
    seen, rows = {}, []
    for text, begins in zip(texts, starts, strict=True):
        for i, names in plain_contexts(text):
            rows.append((names, i in begins))
            for f in names:
                seen.setdefault(f, [0, 0])[i in begins] += 1
    weights = {f: [0.0, 0.0] for f in seen}
    for _ in range(rounds):
        expected = {f: [0.0, 0.0] for f in seen}
        for names, _ in rows:
            p = 1 / (1 + math.exp(-sum(weights[f][1] - weights[f][0] for f in names)))
            for f in names:
                expected[f][0] += 1 - p
                expected[f][1] += p
        for f, w in weights.items():
            for k in (0, 1):
                w[k] += math.log((seen[f][k] + 0.1) / (expected[f][k] + 0.1)) / 6
    return weights


def plain_tokens(text, weights):
    found, start, prob = [], None, 1.0
    places = dict(plain_contexts(text))
    for i in range(len(text) + 1):
        solid = i < len(text) and text[i] not in " \t\r\n"
        if start is not None and i in places:
            p = 1 / (1 + math.exp(-sum(weights[f][1] - weights[f][0] if f in weights else 0 for f in places[i])))
            if p < 0.5:
                prob *= 1 - p
                continue
            found.append((text[start:i], prob * p))
            start, prob = i, 1.0
        elif start is not None and not solid:
            found.append((text[start:i], prob))
            start, prob = None, 1.0
        if start is None and solid:
            start = i
    return found


@pytest.mark.parametrize("piece", [1, 20, 1 << 21])
def test_agrees_with_a_plain_model(spark, monkeypatch, piece):
    monkeypatch.setattr(L, "PIECE", piece)
    df = frame(spark)
    tokens = {r.doc_id: r.t for r in df.select("doc_id", word_tokens(F.col("text")).alias("t")).collect()}
    texts = {k: t for k, t in TEXTS.items() if t is not None}
    weights = plain_fit(texts.values(), [set(L.token_starts(t, tokens[k])) for k, t in texts.items()], 30)
    model = L.fit_splits(df, "text", word_tokens(F.col("text")), rounds=30)
    found = {}
    for r in L.learned_tokens(df, ["doc_id"], "text", model).orderBy("doc_id", "pos").collect():
        found.setdefault(r.doc_id, []).append((r.pos, r.token, r.prob))
    for k, text in texts.items():
        expected = plain_tokens(text, weights)
        assert [(p, t) for p, t, _ in found.get(k, [])] == [(p, t) for p, (t, _) in enumerate(expected)]
        assert [p for *_, p in found.get(k, [])] == pytest.approx([p for _, p in expected], abs=1e-9)
    assert 4 not in found


def test_learns_the_rules_of_its_teacher(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tokens = word_tokens(F.col("text"))
    taught = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(100)) < 30
    model = L.fit_splits(docs.filter(taught), "text", tokens)
    held = L.agreement(docs.filter(~taught), "text", tokens, model).first()
    assert held.n > 1000 and held.n_agree >= 0.999 * held.n
    # Another teacher, another tokenizer: one that parts at blanks only.
    blanks = F.regexp_extract_all("text", F.lit("[^ \\t\\r\\n]+"), F.lit(0))
    other = L.fit_splits(docs, "text", blanks)
    found = L.learned_tokens(docs, ["doc_id"], "text", other).groupBy("doc_id").agg(F.count("*").alias("n"))
    expected = docs.select("doc_id", F.size(blanks).alias("n")).filter("n > 0")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_nothing_to_learn_from(spark):
    empty = frame(spark).limit(0)
    model = L.fit_splits(empty, "text", word_tokens(F.col("text")))
    assert L.learned_tokens(empty, ["doc_id"], "text", model).count() == 0
    assert [r.token for r in L.learned_tokens(frame(spark, {1: "ab c"}), ["doc_id"], "text", model).orderBy("pos").collect()] == ["a", "b", "c"]
