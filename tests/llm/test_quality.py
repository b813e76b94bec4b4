import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from articlemill.llm import language_id, quality_classifier, quality_rules, queries
from articlemill.llm.text_stats import COUNTS, FEATURES, measure, with_statistics
from tests.llm.frames import by_key, documents, no_documents, odd_documents, words

SMALL = "/root/testdata/sf0.01"


def brute_counts(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    covered = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 5)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return [len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(covered)]


@pytest.mark.parametrize("text", [
    None, "", " \n ", "a b c d e a b c d e", "a a a a a a", "x\nx \nx\n\n\ny", "1 2 3 4 5 6 1 2 3 4 5 7 2 3 4 5 6",
    "über # $ | <>", " ".join(words(1, 300, 3)), "\x1c\x85 odd \x0b blanks\x0c",
])
def test_counts_agree_with_brute_force(text):
    assert measure(None if text is None else text.encode())[0] == brute_counts(text)


def test_repeats_among_many_distinct_words():
    text = " ".join(f"v{i}" for i in range(9000)) + " again v5 v6 v7 v8 v9 end"
    assert measure(text.encode())[0][4] == 10


def test_statistics_of_odd_rows(spark):
    found = with_statistics(odd_documents(spark).withColumnRenamed("lang", "n_words"))
    assert found.columns == ["doc_id", "source", "n_chars", *COUNTS, "stats"]
    rows = found.collect()
    assert len(rows) == 12 and all(len(r.stats) == len(FEATURES) and np.isfinite(r.stats).all() for r in rows)
    assert with_statistics(no_documents(spark)).count() == 0


def toy(n=600):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(n, len(FEATURES)))
    y = (x[:, 0] - x[:, 2] + 0.3 * draw.normal(size=n) > 0).astype(float)
    return x, y


def test_trees_learn_and_keep_their_constraints():
    x, y = toy()
    signs = np.array([quality_rules.MONOTONE.get(f, 0) for f in FEATURES])
    forest = quality_rules.grow_forest(x, y, signs)
    assert ((forest.probability(x) > 0.5) == y).mean() > 0.9
    for f in np.flatnonzero(signs):
        moved = np.repeat(x[:50], 40, 0)
        moved[:, f] = np.tile(np.linspace(-4, 4, 40), 50)
        steps = np.diff(forest.margin(moved).reshape(50, 40), axis=1) * signs[f]
        assert (steps >= -1e-12).all()


def test_trees_without_a_choice_are_constant():
    for y in (np.ones(20), np.zeros(20), np.empty(0)):
        forest = quality_rules.grow_forest(np.zeros((len(y), len(FEATURES))), y, np.zeros(len(FEATURES)))
        assert len(set(forest.margin(np.random.default_rng(0).normal(size=(5, len(FEATURES)))))) == 1


def test_isotonic_pools_violators():
    total, good = np.array([2.0, 0, 2, 4, 0]), np.array([1.0, 0, 0, 4, 0])
    levels = quality_classifier.isotonic(total, good)
    assert (np.diff(levels) >= 0).all() and levels[0] == levels[2] and levels[3] > 0.9
    assert len(set(quality_classifier.isotonic(np.zeros(4), np.zeros(4)))) == 4


def fitted(spark, labels, docs):
    stats = with_statistics(docs)
    return quality_classifier.fit(stats.join(labels, "doc_id"))


def test_classifier_with_few_or_no_labels(spark):
    docs = documents(spark, {i: "word " * (i + 1) for i in range(40)})
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    model = fitted(spark, none, docs)
    assert set(np.unique(model.score(np.zeros((3, len(FEATURES)))))) == {0.5}
    one = spark.createDataFrame([(3, 1), (4, None), (None, 1)], "doc_id bigint, quality int")
    assert np.isfinite(fitted(spark, one, docs).score(np.zeros((1, len(FEATURES))))).all()


def test_accepted_keeps_columns_and_odd_rows_do_not_crash(spark):
    docs = odd_documents(spark).withColumnRenamed("lang", "score")
    model = quality_classifier.Model(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(quality_classifier.WIDTH + 1), np.full(quality_classifier.BINS, 0.7))
    kept = quality_classifier.accepted(docs, model)
    assert kept.schema == docs.schema and kept.count() == docs.count()
    assert quality_classifier.accepted(docs, model, 0.8).count() == 0
    assert quality_classifier.accepted(no_documents(spark), model).count() == 0


def crc(key, parts):
    return zlib.crc32(str(key).encode()) % parts


def test_queries_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    texts = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    ruled = by_key(queries.op2_quality_rules(spark, SMALL))
    assert set(ruled) == set(texts)
    for key in list(texts)[:60]:
        assert [ruled[key][c] for c in COUNTS] == brute_counts(texts[key].text)
    for r in ruled.values():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.kept and r.base_failed)
    assert all(ruled[k].kept or ruled[k].base_failed for k, q in labels.items() if q == 1)
    scored = by_key(queries.op4_quality_classifier(spark, SMALL))
    assert all(r.held_out == (crc(k, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for k, r in scored.items())
    held = [k for k in labels if scored[k].held_out]
    assert np.mean([scored[k].predicted == labels[k] for k in held]) > 0.97
    named = by_key(queries.op9_language_id(spark, SMALL))
    assert all(r.held_out == (crc(k, 4) == 2) for k, r in named.items())
    assert np.mean([named[k].lang_pred == texts[k].lang for k in named if named[k].held_out]) > 0.98


def test_language_of_odd_rows(spark):
    docs = documents(spark, {i: t for i, t in enumerate(["the cat and the dog"] * 5 + ["le chat et le chien"] * 5)})
    model = language_id.fit(docs.withColumn("lang", F.when(F.col("doc_id") < 5, "en").otherwise("fr")))
    found = by_key(language_id.with_language(odd_documents(spark).withColumnRenamed("lang", "lang_pred"), model))
    assert [found[k].lang_pred for k in (1, 2, 3, 7)] == ["und"] * 4 and found[7].score == 0
    assert found[6].lang_pred in ("en", "fr") and found[8].lang_pred in ("en", "fr")
    assert model.predict(["the dog and cat", "le chien et chat"])[0] == ["en", "fr"]
    empty = language_id.fit(no_documents(spark))
    assert empty.predict(["some text", None])[0] == ["und", "und"]
    assert language_id.with_language(no_documents(spark), model).count() == 0


def test_numerals_are_no_letters():
    assert not any(map(language_id.has_letter, ["", "½ ² ①", "Ⅷ", "12_3 !?", "٣"]))
    assert all(map(language_id.has_letter, ["a", "½ é", "你", "ʰ", "Ⅷth"]))


def test_code_words_differ():
    for n in (1, 2, 4, 7, 8, 30):
        words_of = language_id.code_words(n)
        assert len(words_of) == n and set(np.unique(words_of)) <= {-1, 1}
        assert n == 1 or len({tuple(w) for w in words_of}) == n
