import itertools
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from articlemill.functions.text import SENTENCE
from articlemill.operators import tagger as G

X = re.compile(SENTENCE)
COUNTS = [("|", "O", 6), ("|", "P", 2), ("O", "O", 9), ("O", "P", 4), ("O", "L", 1), ("P", "P", 3), ("P", "O", 5), ("L", "O", 2), ("O", "|", 4), ("P", "|", 3), ("L", "|", 1)]
WORDS = [("O", "the", 9), ("O", "saw", 3), ("P", "Ann", 4), ("P", " Aa", 5), ("L", " Aa", 2), ("O", " a", 7), ("O", " -", 3), ("P", "saw", 1)]
TEXTS = {1: "the Ann saw the. Bob saw Ann Lee", 2: "", 3: None, 4: " \n", 5: "Xy the? Saw! the the the Zed", 6: "7 -- été"}


def sentence_score(model, rows, tags):
    """The logarithm of the chance of a sentence with a sequence of tags."""
    edge = len(model.tags)
    path = [edge, *tags, edge]
    steps = sum(model.steps[a, b] for a, b in itertools.pairwise(path))
    return steps + sum(model.chances[r, t] for r, t in zip(rows, tags, strict=True))


def every_path(model, rows):
    return {tags: sentence_score(model, rows, tags) for tags in itertools.product(range(len(model.tags)), repeat=len(rows))}


def frame(spark, texts=TEXTS):
    return spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "doc_id int, text string, tag string").repartition(3)


def sentences(spark, df):
    rows = G.tokenised(df, ["doc_id"], "text").collect()
    return {(r.doc_id, r.sent_id): (r.tokens, r.shapes) for r in rows}


def rows_of(model, tokens, shapes):
    return [model.words.get(t, model.words.get(s, len(model.words))) for t, s in zip(tokens, shapes, strict=True)]


@pytest.mark.parametrize("piece", [1, 1 << 18])
def test_tags_and_probabilities_agree_with_all_paths(spark, monkeypatch, piece):
    monkeypatch.setattr(G, "PIECE", piece)
    model, df = G.model_of(COUNTS, WORDS), frame(spark)
    tags, spans = {}, {}
    for r in G.tags_by_context(df, ["doc_id"], "text", model).orderBy("doc_id", "sent_id", "pos").collect():
        tags.setdefault((r.doc_id, r.sent_id), []).append((r.token, r.tag))
    for r in G.entities_with_probability(df, ["doc_id"], "text", model).collect():
        spans[r.doc_id, r.begin, r.end] = r
    expected = sentences(spark, df)
    assert tags.keys() == expected.keys() and len(expected) == 6
    seen = 0
    for key, (tokens, shapes) in expected.items():
        paths = every_path(model, rows_of(model, tokens, shapes))
        best = max(paths.values())
        found = tuple(model.tags.index(t) for _, t in tags[key])
        assert [w for w, _ in tags[key]] == tokens and paths[found] == pytest.approx(best)
        whole = math.log(sum(map(math.exp, paths.values())))
        for tag, first, last in G.runs_of(np.array(found), model.tags.index("O")):
            before = len("".join(X.findall(TEXTS[key[0]])[: key[1]]))
            starts = G.token_offsets(X.findall(TEXTS[key[0]])[key[1]], tokens)
            r, seen = spans[key[0], before + starts[first], before + starts[last] + len(tokens[last])], seen + 1
            both = [math.exp(s - whole) for p, s in paths.items() if set(p[first : last + 1]) == {tag}]
            each = [sum(math.exp(s - whole) for p, s in paths.items() if p[i] == tag) for i in range(first, last + 1)]
            assert r.type == model.tags[tag] and r.text == TEXTS[key[0]][r.begin : r.end]
            assert r.joint == pytest.approx(sum(both)) and r.prob == pytest.approx(sum(each) / len(each))
            assert 0 < r.joint <= 1 and r.joint <= r.prob + 1e-12
    assert seen == len(spans) > 2


def test_shapes(spark):
    words = ["Ann", "McDonald", "ABC", "a", "12a", "été", "Étienne", "..", "x1y2", "中文", "Ⅷ"]
    found = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string").select("i", G.shape(F.col("w")).alias("s"))
    assert [r.s for r in found.orderBy("i").collect()] == [" Aa", " AaAa ld", " A", " a", " 0a", " a", " Aa ne", " -", " a0a0", " a", " 0"]


def test_counts_and_fit(spark):
    gazetteer = spark.createDataFrame([("Ann", "PERSON"), ("Bob", "PERSON"), ("Rome", "LOCATION")], "term string, type string")
    texts = {1: "Ann went to Rome. Bob went home.", 2: "Ann went to Bath.", 3: None, 4: ""}
    tagged = G.tagged_sentences(frame(spark, texts), ["doc_id"], "text", gazetteer)
    steps = {(r.tag, r.next): r.n for r in G.transition_counts(tagged, ["doc_id"]).collect()}
    assert steps == {("|", "PERSON"): 3, ("PERSON", "O"): 3, ("O", "O"): 6, ("O", "LOCATION"): 1, ("LOCATION", "O"): 1, ("O", "|"): 3}
    words = {(r.tag, r.word): r.n for r in G.emission_counts(G.word_counts(tagged), 0.0).collect()}
    assert words == {("PERSON", "Ann"): 2, ("PERSON", " Aa"): 1, ("O", "went"): 3, ("O", "to"): 2, ("O", "."): 3, ("LOCATION", " Aa"): 1, ("O", " a"): 1, ("O", " Aa"): 1}
    few = {(r.tag, r.word): r.n for r in G.emission_counts(G.word_counts(tagged), 0.15).collect()}
    assert few == {("O", "went"): 3, ("O", "."): 3, ("PERSON", " Aa"): 3, ("LOCATION", " Aa"): 1, ("O", " Aa"): 1, ("O", " a"): 3}
    rarer = {(r.tag, r.word): r.n for r in G.emission_counts(G.word_counts(tagged), 0.3).collect()}
    assert rarer == {("PERSON", " Aa"): 3, ("LOCATION", " Aa"): 1, ("O", " Aa"): 1, ("O", " a"): 6, ("O", " "): 3}
    model = G.fit_tagger(tagged, ["doc_id"], 0.0)
    assert np.exp(model.steps).sum(axis=1) == pytest.approx([1] * 4) and np.exp(model.chances).sum(axis=0) == pytest.approx([1] * 3)
    # A name that no list has, at the place where names stand.
    found = G.tags_by_context(frame(spark, {1: "Eve went to York."}), ["doc_id"], "text", model).orderBy("pos").collect()
    assert [r.tag for r in found][:3] == ["PERSON", "O", "O"]


def test_empty_tables(spark):
    none = frame(spark).limit(0)
    gazetteer = spark.createDataFrame([], "term string, type string")
    model = G.fit_tagger(G.tagged_sentences(none, ["doc_id"], "text", gazetteer), ["doc_id"])
    assert model.tags == ["O"] and G.tags_by_context(none, ["doc_id"], "text", model).count() == 0
    assert [r.tag for r in G.tags_by_context(frame(spark, {1: "a b"}), ["doc_id"], "text", model).collect()] == ["O", "O"]
    assert G.entities_with_probability(frame(spark), ["doc_id"], "text", model).count() == 0
