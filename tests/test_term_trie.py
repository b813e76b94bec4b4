import random

import pytest

from articlemill.operators import term_trie as A


def brute(text, terms):
    """The longest term at each place from the left, by trying every run of tokens."""
    lengths = sorted({len(t) for t, _ in terms}, reverse=True)
    kinds = {}
    for words, kind in terms:
        kinds.setdefault(words, set()).add(kind)
    tokens = list(A.TOKEN.finditer(text))
    found, i = [], 0
    while i < len(tokens):
        for n in lengths:
            words = tuple(t[0] for t in tokens[i : i + n])
            if n and len(words) == n and words in kinds:
                begin, end = tokens[i].start(), tokens[i + n - 1].end()
                found += [(begin, end, kind, text[begin:end]) for kind in kinds[words]]
                i += n - 1
                break
        i += 1
    return sorted(found)


def result(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.doc_id, []).append((r.begin, r.end, r.type, r.text))
    return {k: sorted(v) for k, v in found.items()}


def tables(spark, texts, terms):
    docs = spark.createDataFrame([(k, t, "x", 0) for k, t in texts.items()], "doc_id int, text string, type string, begin int").repartition(3)
    return docs, spark.createDataFrame(terms, "term string, type string")


@pytest.mark.parametrize("shard", [10, 60, 1 << 20])
def test_odd_terms_and_texts(spark, monkeypatch, shard):
    monkeypatch.setattr(A, "SHARD_BYTES", shard)
    texts = {1: "New  York City, new York\nNew York.", 2: None, 3: "", 4: " \n", 5: "a b a b c a b a", 6: "Ünï_x e-mail: St. Mary's!", 7: "New York City" * 2}
    terms = [("New York", "L"), ("New York City", "L"), ("New York", "O"), ("York", "P"), ("a b a", "X"), ("b c", "X"), ("b", "Y"), ("St. Mary's", "O"),
             ("e - mail", "N"), ("", "E"), (None, "E"), (" ", "E"), ("New York", "L"), ("_", None)]
    docs, gazetteer = tables(spark, texts, terms)
    found = result(A.term_spans(docs, ["doc_id"], "text", gazetteer))
    split = [(tuple(A.TOKEN.findall(t or "")), k) for t, k in terms]
    expected = {k: sorted(brute(t, split), key=repr) for k, t in texts.items() if t and t.strip()}
    assert {k: sorted(v, key=repr) for k, v in found.items()} == {k: v for k, v in expected.items() if v}
    assert A.term_spans(docs.limit(0), ["doc_id"], "text", gazetteer).count() == 0
    assert A.term_spans(docs, ["doc_id"], "text", gazetteer.limit(0)).count() == 0


def test_a_hundred_thousand_terms(spark, monkeypatch):
    monkeypatch.setattr(A, "SHARD_BYTES", 800_000)
    draw = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    terms = list({(" ".join(draw.choices(words, k=draw.randint(1, 8))), draw.choice("ABC")) for _ in range(100_000)})
    texts = {i: " ".join([draw.choice(terms)[0] if draw.random() < 0.3 else draw.choice(words) for _ in range(60)]) for i in range(30)}
    docs, gazetteer = tables(spark, texts, terms)
    assert A.shard_count(gazetteer) > 2
    found = result(A.term_spans(docs, ["doc_id"], "text", gazetteer))
    split = [(tuple(t.split(" ")), k) for t, k in terms]
    assert found == {k: brute(t, split) for k, t in texts.items()}
