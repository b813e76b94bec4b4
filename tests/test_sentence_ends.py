import math
import random
import re

import pytest

from articlemill.operators import sentence_ends as S

STORY = [
    "Mr. Smith met Dr. Lee in the U.S. last May.", "The firm paid 3.5 million to Mr. Smith.", "He saw Mr. Brown.", "Dr. Lee left for the U.S. The trip was long.",
    "One day in May a long brown car came later than the others.", "It was the end of the day.", "She met the men at the end.", "They saw him, and the rest of them met him later.", "He met Mr. Lee, etc. and left.",
]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)


def plain_statistics(texts):
    counts = {}
    for text in texts:
        for hit in re.findall(r"[^\W_][^\W_.'-]*(?:[.'-]+[^\W_.'-]+)*[.'-]*", text or ""):
            form = hit.rstrip(".'-")
            row = counts.setdefault(form.lower(), [0, 0, 0])
            row[0] += 1
            row[1] += hit.endswith(".") and not hit.endswith("..")
            row[2] += form[0] == form[0].lower()
    total, periods = (sum(r[i] for r in counts.values()) for i in (0, 1))
    rate = min(max(periods / total, 1e-9), 1 - 1e-9)
    found = {}
    for word, (n, k, low) in counts.items():
        inner = word.count(".")
        length = len(word) - inner
        ratio = 2 * (k * (math.log(0.99) - math.log(rate)) + (n - k) * (math.log(0.01) - math.log(1 - rate)))
        found[word] = (n, k, low, ratio * math.exp(-length) * (inner + 1) * length ** -float(n - k) if k else None)
    return found


def test_statistics_agree_with_plain_counts(spark):
    draw = random.Random(1)
    texts = [*STORY * 3, "", None, "...", "a.b.c. A.B.C. x... y- z' Été. été", " ".join(draw.choice("aAbé.' -\n") for _ in range(500))]
    found = {r.word: (r.n, r.n_period, r.n_lower, r.score) for r in S.word_statistics(frame(spark, texts), "text").collect()}
    expected = plain_statistics(texts)
    assert found.keys() == expected.keys()
    for word, row in expected.items():
        assert found[word][:3] == row[:3], word
        assert found[word][3] == (None if row[3] is None else pytest.approx(row[3], abs=1e-6)), word


def test_abbreviations_do_not_end_sentences(spark):
    docs = frame(spark, STORY * 20)
    model = S.fit_ends(S.word_statistics(docs, "text"))
    assert {"mr", "dr", "u.s", "etc"} <= model.abbreviations and not {"end", "day", "smith", "lee", "brown"} & model.abbreviations
    found = {}
    for r in S.learned_sentences(docs, ["doc_id"], "text", model).orderBy("doc_id", "sent_id").collect():
        found.setdefault(r.doc_id, []).append(r.text)
    for i in range(len(STORY)):
        expected = ["Dr. Lee left for the U.S.", "The trip was long."] if i == 3 else [STORY[i]]
        assert found[i] == expected


def test_ends_of_all_kinds(spark):
    model = S.EndModel(frozenset({"mr", "u.s"}), frozenset({"the", "no"}))
    cases = {
        "": [], " \n ": [], "No marks": ["No marks"], "One. Two! Three? four": ["One.", "Two!", "Three?", "four"],
        "Mr. Smith came.": ["Mr. Smith came."], "In the U.S. the law": ["In the U.S. the law"], "In the U.S. The law": ["In the U.S.", "The law"],
        "It cost 3.5 or 10.0.0.1 units. No": ["It cost 3.5 or 10.0.0.1 units.", "No"], "J. Smith and K. Lee": ["J. Smith and K. Lee"],
        'He said "yes." No?! (Ok.) Fine': ['He said "yes."', "No?!", "(Ok.)", "Fine"], "Well... then... Then so…  so": ["Well... then...", "Then so…  so"],
        "Ends with Mr.": ["Ends with Mr."], "a.b@c.de x": ["a.b@c.de x"], "\tOne.\r\nTwo": ["One.", "Two"],
    }
    rows = S.learned_sentences(frame(spark, [*cases, None]), ["doc_id"], "text", model).orderBy("doc_id", "sent_id").collect()
    texts = list(cases)
    for i, (text, expected) in enumerate(cases.items()):
        own = [r for r in rows if r.doc_id == i]
        assert [r.text for r in own] == expected, text
        assert [r.sent_id for r in own] == list(range(len(own)))
        assert all(texts[i][r.begin : r.end] == r.text for r in own)
    assert not [r for r in rows if r.doc_id == len(cases)]


def test_empty_tables(spark):
    none = frame(spark, ["x"]).limit(0)
    statistics = S.word_statistics(none, "text")
    model = S.fit_ends(statistics)
    assert statistics.count() == 0 and model == S.EndModel(frozenset(), frozenset())
    assert S.learned_sentences(none, ["doc_id"], "text", model).count() == 0
