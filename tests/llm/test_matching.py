import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from articlemill.llm import components, decontamination, license_scan, line_dedup, lm_scoring, minhash, queries
from articlemill.llm.oracles import oracles
from articlemill.llm.plain_words import plain_words
from tests.compare import compare, connect
from tests.llm.frames import LONG, by_key, documents, no_documents, odd_documents, words

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracles()))
def test_queries_agree_with_sql(spark, name):
    ok, note = compare(spark, connect(SMALL), SMALL, name, queries.QUERIES[name], oracles()[name])
    assert ok, note


# Components


def test_components_agree_with_brute_force(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)] + [(7, 7), (None, 1)]
    root = {n: n for e in edges if None not in e and e[0] != e[1] for n in e}
    for _ in range(len(edges)):
        for a, b in edges:
            if a is not None and a != b:
                root[a] = root[b] = min(root[a], root[b])
    found = components.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r.node: r.component for r in found.collect()} == root
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# Line dedup


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    return any(a[:i] == b[:i] and a[i + (len(a) == len(b)) :] == b[i + 1 :] for i in range(len(b)))


def brute_lines(texts, least=line_dedup.MIN_CHARS):
    seen, kept = [], {}
    for key in sorted(texts):
        kept[key] = []
        for place, line in enumerate([] if texts[key] is None else texts[key].split("\n")):
            if len(line) < least:
                kept[key].append(place)
                continue
            if not any(line == s or distance_one(line, s) for s in seen):
                kept[key].append(place)
            seen.append(line)
    return kept


def line_texts():
    draw = random.Random(4)
    bases = ["".join(draw.choice("abcdé ") for _ in range(draw.randint(15, 40))) for _ in range(12)]
    texts = {}
    for key in range(40):
        lines = []
        for _ in range(6):
            line = draw.choice(bases)
            for _ in range(draw.choice([0, 0, 1, 1, 2])):
                p = draw.randrange(len(line) + 1)
                line = draw.choice([line[:p] + draw.choice("abé") + line[p:], line[:p] + line[p + 1 :], line[:p] + "x" + line[p + 1 :]])
            lines.append(line)
        texts[key] = "\n".join(lines)
    return texts | {50: None, 51: "", 52: "short\n\nshort", 53: "a" * 30 + "\n" + "a" * 31 + "\n" + "a" * 33}


def test_near_lines_agree_with_brute_force(spark):
    texts = line_texts()
    kept = by_key(line_dedup.line_report(documents(spark, texts)))
    expected = brute_lines(texts)
    wanted = documents(spark, texts).select("doc_id").collect()
    assert len(wanted) == len(kept)
    import hashlib

    for key, places in expected.items():
        assert kept[key].n_kept == len(places), key
        assert kept[key].kept_sha256 == hashlib.sha256(",".join(map(str, places)).encode()).hexdigest()


def test_repeated_lines_leave_the_text(spark):
    texts = line_texts()
    docs = documents(spark, texts).withColumnRenamed("lang", "key").withColumnRenamed("source", "_kept")
    found = line_dedup.without_repeated_lines(docs)
    assert found.schema == docs.schema
    rows, expected = by_key(found), brute_lines(texts)
    for key, text in texts.items():
        left = None if text is None else "\n".join(text.split("\n")[p] for p in expected[key])
        if text and text.strip() and not left.strip():
            assert key not in rows
        else:
            assert rows[key].text == left


def test_lines_of_odd_rows(spark):
    docs = odd_documents(spark)
    found = line_dedup.without_repeated_lines(docs)
    assert sorted((r.doc_id or 0) for r in found.collect()) == [0, 1, 2, 3, 4, 6, 7, 8, 9, 9, 10]
    assert line_dedup.line_report(docs).count() == docs.count()
    assert line_dedup.without_repeated_lines(no_documents(spark)).count() == 0
    assert line_dedup.line_report(no_documents(spark)).count() == 0


def test_line_dedup_runs_no_python(spark):
    plan = line_dedup.without_repeated_lines(odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# MinHash


def brute_near(texts, width, percent):
    sets = {}
    for key, text in texts.items():
        found = [w.decode() for w in (text or "").encode().translate(minhash.LOWER).split()]
        n = min(width, len(found)) or 1
        sets[key] = {tuple(found[i : i + n]) for i in range(len(found) - n + 1)} if found else set()
    root = {k: k for k in texts}
    linked = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in texts:
        for a, b in linked:
            root[a] = root[b] = min(root[a], root[b])
    return {k: (len(sets[k]), root[k]) for k in texts}


def near_texts():
    draw, texts = random.Random(6), {}
    for group in range(6):
        base = words(group, 60)
        for copy in range(25):
            changed = list(base)
            for _ in range(draw.choice([0, 1, 2, 3, 4, 5])):
                changed[draw.randrange(len(base))] = f"n{draw.randrange(9)}"
            texts[group * 100 + copy] = (" ".join(changed)).upper() if copy % 5 == 0 else " ".join(changed)
    return texts | {900: None, 901: "", 902: " ", 903: "one", 904: "ONE", 905: "one two"}


@pytest.mark.parametrize("width,block", [(2, 512), (5, 512), (2, 7)])
def test_near_duplicates_agree_with_brute_force(spark, monkeypatch, width, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    texts = near_texts()
    found = by_key(minhash.near_duplicates(documents(spark, texts), words=width))
    assert {k: (r.n_shingles, r.component_id) for k, r in found.items()} == brute_near(texts, width, 80)
    assert all(r.kept == (k == r.component_id) for k, r in found.items())


def test_one_of_each_group_stays(spark):
    texts = near_texts()
    docs = documents(spark, texts).withColumnRenamed("lang", "kept").withColumnRenamed("source", "component_id")
    found = minhash.without_near_duplicates(docs)
    assert found.schema == docs.schema
    assert sorted(by_key(found)) == sorted({c for _, c in brute_near(texts, 5, 80).values()})
    odd = odd_documents(spark)
    assert sorted((r.doc_id or 0) for r in minhash.without_near_duplicates(odd).collect()) == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10]
    assert minhash.near_duplicates(odd).count() == odd.count()
    clashing = odd.withColumnsRenamed({"lang": "_place", "source": "_decided", "n_chars": "kept"})
    assert minhash.without_near_duplicates(clashing).count() == minhash.without_near_duplicates(odd).count()
    assert minhash.without_near_duplicates(no_documents(spark)).count() == 0


def test_texts_of_one_key_are_one_document(spark):
    one, two = " ".join(words(1, 50)), " ".join(words(2, 50))
    docs = spark.createDataFrame([(1, one), (5, one), (5, two), (7, two + " end"), (7, two + " end"), (9, "alone")], "doc_id bigint, text string")
    found = minhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (5, 1), (5, 1), (7, 1), (7, 1), (9, 9)]


def test_pruning_misses_rarely():
    needed = minhash.least_matches(80)
    assert list(needed) == list(range(32, 257, 32)) and all(0.3 * n < k < 0.8 * n for n, k in needed.items())
    assert sorted(needed.values()) == list(needed.values())


# Decontamination


def brute_contamination(text, items, width=10):
    found = plain_words(text.encode()) if text else []
    hit, ids = set(), set()
    for item, t in items:
        cut = plain_words(t.encode()) if t else []
        for s in range(max(1, len(cut) - width + 1)) if cut else ():
            window = cut[s : s + width]
            for i in range(len(found) - len(window) + 1):
                if found[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    ids.add(str(item) if item is not None else "")
    return len(found), len(hit), sorted(ids)


@pytest.mark.parametrize("few,blocks,memo,rows", [(200_000, 1, 0, 200_000), (0, 1 << 20, 200_000, 200_000), (0, 2, 0, 0)])
def test_contamination_agrees_with_brute_force(spark, monkeypatch, few, blocks, memo, rows):
    monkeypatch.setattr(decontamination, "SET_WORDS", few)
    monkeypatch.setattr(decontamination, "FILTER_BLOCKS", blocks)
    monkeypatch.setattr(decontamination, "MEMO", memo)
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", rows)
    items = [(i, " ".join(words(i, 25, 30))) for i in range(12)] + [(20, "three word item"), (21, None), (22, "..."), (None, "Keyless, item"), (3, "a second text of item three")]
    draw, texts = random.Random(8), {}
    for key in range(40):
        parts = words(100 + key, 40, 30)
        for _, t in draw.sample(items, 3):
            cut = (t or "").split()
            start = draw.randrange(max(1, len(cut) - 12))
            parts += cut[start : start + draw.choice([9, 10, 12, 30])]
        texts[key] = ", ".join(parts) if key % 2 else " ".join(parts).upper()
    texts |= {50: None, 51: "", 52: "THREE-word; item", 53: LONG, 54: texts[1], 55: "of the of the of the of the of the of the"}
    items += [(30, "of the of the"), (31, "the of the of the of the of the of"), (32, "of")]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents(spark, texts).withColumnRenamed("lang", "hits")
    found = by_key(decontamination.find_contamination(docs, table))
    for key, text in texts.items():
        r = found[key]
        assert (r.n_words, sum(h.end - h.begin for h in r.hits), r["items"]) == brute_contamination(text, items), key
    clean = decontamination.without_contaminated(docs, table)
    assert clean.schema == docs.schema
    assert sorted(by_key(clean)) == [k for k in texts if not found[k].hits]


def test_contamination_of_odd_rows(spark):
    docs, none = odd_documents(spark), spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.without_contaminated(docs, none).count() == docs.count()
    items = spark.createDataFrame([(1, "equal row of ten")], "item_id bigint, text string")
    assert decontamination.without_contaminated(docs, items).count() == docs.count() - 2
    assert decontamination.digest(decontamination.find_contamination(no_documents(spark), items)).count() == 0


# License scan

NOTICE = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction"""


@pytest.mark.parametrize("text,labels", [
    ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0"),
    ("Licensed under the Apache License 2.0", "apache,apache-2.0"),
    ("Licensed under the Apache License, edition 2.0", "apache"),
    ("GNU General Public License as published by the Free Software Foundation; either version 2", "gpl,gpl-2.0"),
    ("GNU General Public License as published by the Free Software; either version 2", "gpl"),
    ("GNU General Public License, version 3, or (at your option) any later version", "gpl,gpl-3.0,gpl-or-later"),
    ("CC BY-NC 4.0 and CC-BY 4.0", "cc-by,cc-by-4.0,cc-by-nc-4.0"),
    (NOTICE, "mit-grant"), (NOTICE.replace("charge", "cost"), ""), (NOTICE.replace("the Software", "all of this very large Software"), ""),
    ("GNU General Public License v3.0", "gpl,gpl-3.0"), ("GNU General Public License, Version v2", "gpl,gpl-2.0"), ("Apache License v2.0", "apache,apache-2.0"),
    ("released under the MIT license, not really", "mit,mit-reference"),
    ("Copyright (c) 2020 Some One. All rights reserved.", "all-rights-reserved"),
    ("Copyright (c) " + "x " * 9 + "All rights reserved.", ""), ("apache licenses", ""), ("", ""), (None, ""),
])
def test_templates(text, labels):
    found = license_scan.scan_text(None if text is None else text.encode(), license_scan.PHRASES, tuple(license_scan.TEMPLATES))
    assert ",".join(found.labels) == labels
    assert found.score == (1.0 if set(found.labels) - set(license_scan.PHRASES.values()) else 0.5 if labels else 0.0)


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""


def labels_of(text):
    return license_scan.scan_text(text.encode(), license_scan.PHRASES, tuple(license_scan.TEMPLATES)).labels


def filled(markup, optional, names):
    """A notice with its regions filled in or left out."""
    text = re.sub("<<opt>>(.*?)<</opt>>", r"\1" if optional else "", markup, flags=re.S)
    return re.sub("<<var;max=(\\d+)>>", lambda m: names if int(m[1]) > 1 else "", text)


def test_whole_notices_are_accepted_and_altered_ones_refused():
    assert "mit-notice" in labels_of("Copyright 2020 A. Person\n\n" + MIT + "\nAnd more.")
    assert "mit-notice" in labels_of(MIT.replace("THE AUTHORS OR COPYRIGHT HOLDERS", "Acme Inc."))
    draw = random.Random(3)
    for label, markup in license_scan.NOTICES:
        for optional in (False, True):
            words_of = filled(markup, optional, "the owners and friends").split()
            assert label in labels_of("x " + " ".join(words_of).title() + ". y"), label
            fixed = set(filled(markup, False, "").split())
            for _ in range(25):
                at = draw.randrange(len(words_of))
                if words_of[at] not in {"the", "owners", "and", "friends", "or", "including", "next", "paragraph", "txt"} & (fixed | {"owners", "friends"}):
                    assert label not in labels_of(" ".join([*words_of[:at], "qqq", *words_of[at + 1 :]])), (label, at)
            assert label not in labels_of(" ".join(words_of[:-1]))


def test_notices_as_expressions_and_as_automata_agree():
    from articlemill.llm.oracles import expression

    draw = random.Random(4)
    for label, markup in license_scan.NOTICES:
        for _ in range(30):
            words_of = filled(markup, draw.random() < 0.5, " ".join(["some"] * draw.randint(0, 14))).split()
            if draw.random() < 0.5:
                del words_of[draw.randrange(len(words_of))]
            text = " ".join(["a", *words_of, "b"])
            assert (label in labels_of(text)) == bool(re.search(expression(markup), f" {text} ")), text


def test_phrase_places_and_odd_rows(spark):
    found = license_scan.scan_text(b"CC BY CC by! apache License cc", license_scan.PHRASES, ())
    assert (found.n_words, found.n_base, found.first_word, found.last_word) == (7, 3, 0, 4)
    rows = license_scan.with_licenses(odd_documents(spark).withColumnRenamed("lang", "labels")).collect()
    assert len(rows) == 12 and all(r.first_word is None and r.n_base == 0 for r in rows)
    assert license_scan.with_licenses(no_documents(spark)).count() == 0


@pytest.mark.parametrize("template", ["<<opt>>a<</opt>> b c", "a", "a b <<opt>>c", "<<var;max=2>> a b"])
def test_bad_templates_are_refused(template):
    with pytest.raises((ValueError, IndexError)):
        license_scan.compile_template("x", template)


# LM scoring


def brute_scores(texts, target, share, least):
    from collections import Counter
    from math import log

    cut = {k: (t or "").lower().split() for k, t in texts.items()}
    seen = Counter(w for k in target for w in cut[k])
    known = {w for w, n in seen.items() if n >= max(2, share * sum(seen.values()))}
    cut = {k: [w if w in known else "?" for w in ws] for k, ws in cut.items()}
    models = []
    for keys in (texts, target):
        pairs = Counter(p for k in keys for p in zip(["^", *cut[k]], cut[k]))
        single, history = Counter(w for k in keys for w in cut[k]), Counter()
        for (h, _), n in pairs.items():
            history[h] += n
        models.append((pairs, single, history, sum(single.values())))

    def chance(model, h, w):
        pairs, single, history, total = model
        n = pairs[h, w] if pairs[h, w] >= least else 0
        return 0.6 * n / max(history[h], 1) + 0.4 * (single[w] + 1) / (total + len(known) + 1)

    return {k: round(sum(log(chance(models[0], h, w)) - log(chance(models[1], h, w)) for h, w in zip(["^", *ws], ws)) / len(ws), 6) if ws else None for k, ws in cut.items()}


@pytest.mark.parametrize("block_tokens", [1, 300, 1 << 21])
def test_scores_agree_with_brute_force(spark, monkeypatch, block_tokens):
    monkeypatch.setattr(lm_scoring, "BLOCK_TOKENS", block_tokens)
    monkeypatch.setattr("articlemill.llm.common.PIECE_BYTES", 500)
    texts = {k: " ".join(words(k % 7, 50, 15) + words(k, 30, 40)).replace("w1", "W1") for k in range(60)} | {70: None, 71: "", 72: "unheard of"}
    target = [k for k in range(60) if k % 7 < 2]
    docs = documents(spark, texts).withColumn("good", F.when(F.col("doc_id") < 60, F.col("doc_id") % 7 < 2))
    found = by_key(lm_scoring.score_documents(docs, "good", word_share=0.01))
    expected = brute_scores(texts, target, 0.01, lm_scoring.LEAST)
    assert set(found) == set(expected)
    for key, score in expected.items():
        assert found[key].score == (None if score is None else pytest.approx(score, abs=2e-6)), key


@pytest.mark.parametrize("block_tokens,bucket_keys", [(1 << 21, 1 << 20), (5000, 1 << 20), (5000, 700), (1, 100)])
def test_rare_words_and_pairs_count(spark, monkeypatch, block_tokens, bucket_keys):
    """Each word that the target has twice is its own, and each pair counts, however documents and hashes are parted."""
    monkeypatch.setattr(lm_scoring, "BLOCK_TOKENS", block_tokens)
    monkeypatch.setattr(lm_scoring, "BUCKET_KEYS", bucket_keys)
    monkeypatch.setattr("articlemill.llm.common.PIECE_BYTES", 5000)
    # 300,000 tokens of one word: a word that occurs twice has far less than 1 in 100,000 of the target's.
    texts = {k: " ".join(words(k % 7, 50, 15) + words(k, 30, 400)) for k in range(60)} | {60: "tick " * 300_000, 61: "rare twin", 62: "a rare twin", 63: "rare alone"}
    texts |= {70: None, 71: "", 72: "unheard of", 73: "unheard of rare"}
    target = [k for k in texts if k < 70 and (k >= 60 or k % 7 < 2)]
    docs = documents(spark, texts).withColumn("good", F.col("doc_id").isin(target))
    found = by_key(lm_scoring.score_documents(docs, "good"))
    expected = brute_scores(texts, target, 0.0, 1)
    assert set(found) == set(expected)
    for key, score in expected.items():
        assert found[key].score == (None if score is None else pytest.approx(score, abs=2e-6)), key


def test_scores_of_odd_rows(spark):
    docs = odd_documents(spark).withColumn("good", F.col("doc_id") == 9)
    assert lm_scoring.score_documents(docs, "good").count() == 11
    none = lm_scoring.score_documents(docs.withColumn("good", F.lit(None).cast("boolean")), "good").collect()
    assert len(none) == 11
    assert lm_scoring.score_documents(no_documents(spark).withColumn("good", F.lit(True)), "good").count() == 0
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")).withColumnsRenamed({"lang": "block", "source": "n_tokens"})
    assert sorted(map(repr, {r.doc_id: r.score for r in lm_scoring.score_documents(named, "good").collect()}.values())) == sorted(repr(r.score) for r in lm_scoring.score_documents(docs, "good").collect())


def test_numbers_survive_packing():
    import numpy as np

    for values in ([], [0], [0, 0, 0], [5, 1 << 40, 3], [(1 << 64) - 1, 0]):
        numbers = np.array(values, np.uint64)
        assert lm_scoring.unpacked(lm_scoring.packed(numbers)).tolist() == values
        assert lm_scoring.unpacked(lm_scoring.packed(np.sort(numbers), True), True).tolist() == sorted(values)
