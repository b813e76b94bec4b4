"""The fitted operators and the pipeline's rows against plain computations of the same definitions."""

import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from articlemill.llm import language_id, quality_classifier, quality_rules
from articlemill.llm.common import stored
from articlemill.llm.queries import tokenizer_path
from articlemill.llm.text_stats import FEATURES, measured, with_statistics
from tests.llm.frames import by_key, documents
from tests.llm.test_matching import brute_contamination, brute_lines, brute_near

SMALL = "/root/testdata/sf0.001"


def labelled_texts(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    return texts, labels


def part(key, parts):
    return zlib.crc32(str(key).encode()) % parts


def plain_classifier(x, y, keys):
    """Ridge by least squares on the stacked rows, and the pooled levels by the greatest lower bound of means."""
    mean, spread = x.mean(0), x.std(0)
    spread[spread < 1e-9] = 1
    calibrates = np.array([part(k, 5) == 4 for k in keys])
    z = quality_classifier.random_features((x - mean) / spread)
    own = z[~calibrates]
    n = len(own)
    stacked = np.vstack([own, np.sqrt(quality_classifier.RIDGE * n) * np.eye(own.shape[1])])
    weights = np.linalg.lstsq(stacked, np.append(y[~calibrates], np.zeros(own.shape[1])), rcond=None)[0]
    raw = z[calibrates] @ weights
    bins = quality_classifier.bin_of(raw)
    total, good = np.bincount(bins, minlength=quality_classifier.BINS), np.bincount(bins, y[calibrates], quality_classifier.BINS)
    filled = np.flatnonzero(total)
    levels = {}
    for j, b in enumerate(filled):  # the least mean over ends, of the greatest over starts
        levels[b] = max(min(good[filled[i : e + 1]].sum() / total[filled[i : e + 1]].sum() for e in range(j, len(filled))) for i in range(j + 1))
    return mean, spread, weights, levels


def test_classifier_agrees_with_a_direct_solve(spark):
    texts, labels = labelled_texts(spark)
    keys = sorted(labels)
    model = quality_classifier.fit(with_statistics(documents(spark, {k: texts[k] for k in keys})).join(spark.createDataFrame(list(labels.items()), "doc_id bigint, quality int"), "doc_id"))
    x = measured([texts[k].encode() for k in keys])[1]
    mean, spread, weights, levels = plain_classifier(x, np.array([labels[k] for k in keys], float), keys)
    assert model.mean == pytest.approx(mean) and model.spread == pytest.approx(spread)
    z = quality_classifier.random_features((x - mean) / spread)
    assert model.raw(x) == pytest.approx(z @ weights, abs=1e-5)
    # The same bins are pooled: levels rise where the plain ones do.
    own = np.array([model.levels[b] for b in sorted(levels)])
    plain = np.array([levels[b] for b in sorted(levels)])
    assert (np.diff(own) >= -1e-12).all() and own == pytest.approx(plain, abs=0.02)


def walked(forest, row):
    """The log-odds of one row, node by node."""
    total = forest.base
    for node in forest.roots:
        while forest.left[node] != node:
            node = forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
        total += forest.value[node]
    return total


def test_forest_agrees_with_a_walk_along_its_nodes(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(300, len(FEATURES)))
    y = (x[:, 0] - x[:, 2] > 0).astype(float)
    forest = quality_rules.grow_forest(x, y, np.zeros(len(FEATURES)))
    for row, margin in zip(x[:40], forest.margin(x[:40]), strict=True):
        assert margin == pytest.approx(walked(forest, row))


def plain_languages(texts, languages):
    """Codewords by their losses, each bit by a ratio of mean shares of 3-grams."""
    names = sorted(set(languages.values()))
    counts = {name: {} for name in names}
    for k, name in languages.items():
        for g in language_id.gram_buckets(texts[k]).tolist():
            counts[name][g] = counts[name].get(g, 0) + 1
    sums = {name: sum(c.values()) + 0.5 * language_id.BUCKETS for name, c in counts.items()}
    words = language_id.code_words(len(names))

    def share(name, g):
        return (counts[name].get(g, 0) + 0.5) / sums[name]

    def predict(text):
        grams = language_id.gram_buckets(text).tolist()
        if not any(c.isalpha() for c in text) or not grams:
            return None
        losses = []
        margins = []
        for bit in range(words.shape[1]):
            has, not_has = ([n for n, w in zip(names, words[:, bit], strict=True) if (w > 0) == side] for side in (True, False))
            if not has or not not_has:
                margins.append(0.0)
                continue
            margins.append(sum(math.log(sum(share(n, g) for n in has) / len(has)) - math.log(sum(share(n, g) for n in not_has) / len(not_has)) for g in grams) / len(grams))
        for row in words:
            losses.append(sum(math.log1p(math.exp(-6.0 * m * w)) for m, w in zip(margins, row, strict=True)))
        weights = [math.exp(min(losses) - v) for v in losses]
        return names[losses.index(min(losses))], max(weights) / sum(weights)

    return predict


def test_languages_agree_with_a_plain_model(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()
    texts, languages = {r.doc_id: r.text[:400] for r in rows}, {r.doc_id: r.lang for r in rows}
    docs = spark.createDataFrame([(k, t, languages[k]) for k, t in texts.items()], "doc_id bigint, text string, lang string").repartition(3)
    found = by_key(language_id.with_language(docs, language_id.fit(docs)))
    predict = plain_languages(texts, languages)
    for k, text in texts.items():
        name, score = predict(text)
        assert found[k].lang_pred == name and found[k].score == pytest.approx(score, abs=2e-6)


def test_each_stage_keeps_what_brute_force_keeps(spark):
    """Each stage is judged on its own input. Exact copies, near copies, benchmark passages and repeated lines are planted."""
    texts, labels = labelled_texts(spark)
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    base = {k: texts[k] for k in sorted(texts)[:110]}
    some = [k for k in base if len((base[k] or "").split()) > 60][:6]
    base |= {900 + i: base[k] for i, k in enumerate(some)}
    base |= {920 + i: " ".join(["changed", *base[k].split()[1:]]) for i, k in enumerate(some)}
    base |= {940 + i: f"{base[k]}\n{items[i][1]}" for i, k in enumerate(some)}
    docs = documents(spark, base)
    library = Tokenizer.from_file(tokenizer_path())
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stored(stage(spark, docs, SMALL), name)
        after = by_key(docs)
        if name == "quality_classifier":
            train = {k: q for k, q in labels.items() if part(k, 3) != 1 and k in before}
            x = measured([before[k].encode() for k in sorted(train)])[1]
            mean, spread, weights, levels = plain_classifier(x, np.array([train[k] for k in sorted(train)], float), sorted(train))
            raw = quality_classifier.random_features((measured([t.encode() for t in before.values()])[1] - mean) / spread) @ weights
            at = sorted(levels)
            plain = np.interp(raw, quality_classifier.bin_middles()[at], [levels[b] for b in at])
            clear = {k: p > 0.5 for k, p in zip(before, plain, strict=True) if abs(p - 0.5) > 0.2}
            assert len(clear) > 0.8 * len(before) and all((k in after) == kept for k, kept in clear.items())
        elif name == "line_dedup":
            kept = brute_lines(before)
            expected = {k: "\n".join(t.split("\n")[p] for p in kept[k]) for k, t in before.items()}
            assert {k: r.text for k, r in after.items()} == {k: t for k, t in expected.items() if t.strip()}
        elif name == "near_duplicates":
            assert sorted(after) == sorted({c for _, c in brute_near(before, 5, 80).values()})
        elif name == "decontamination":
            assert sorted(after) == sorted(k for k, t in before.items() if not brute_contamination(t, items)[1])
        else:
            ids = {k: library.encode(t, add_special_tokens=False).ids for k, t in before.items()}
            assert {k: r.ids for k, r in after.items()} == ids
            assert all(r.decoded_sha256 == hashlib.sha256(before[k].encode()).hexdigest() for k, r in after.items())
        assert 0 < len(after) <= len(before)
