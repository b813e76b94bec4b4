import random

from articlemill.operators import relation_patterns as L

SCHEMA = "doc_id int, left_text string, right_text string, left_type string, between string, right_type string"


def plain(rows, seeds, rounds, support, confidence):
    """The fixpoint by sets in plain Python."""
    occurring = {(r[1], r[2], r[3:]) for r in rows if None not in r[1:]}
    known = {s: 1.0 for s in seeds if None not in s}
    patterns = {}
    for _ in range(rounds):
        patterns = {}
        for context in {c for *_, c in occurring}:
            for rel in {r for *_, r in known}:
                lefts = {a for a, _, r in known if r == rel}
                near = [(a, b) for a, b, c in occurring if c == context and a in lefts]
                good = sum((a, b, rel) in known for a, b in near)
                if good >= support and good / len(near) >= confidence:
                    patterns[(*context, rel)] = (good, good / len(near))
        before = len(known)
        for (*context, rel), (_, share) in patterns.items():
            for a, b, c in occurring:
                if c == tuple(context):
                    known[a, b, rel] = max(known.get((a, b, rel), 0), share)
        if len(known) == before:
            break
    return known, patterns


def learned(spark, rows, seeds, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = L.learn_relations(df, spark.createDataFrame(seeds, "left_text string, right_text string, rel_type string"), **options)
    relations = {(r.left_text, r.right_text, r.rel_type): r.confidence for r in found.relations.collect()}
    patterns = {(r.left_type, r.between, r.right_type, r.rel_type): (r.support, r.confidence) for r in found.patterns.collect()}
    return relations, patterns, found.rounds


def test_seeds_recover_planted_relations(spark):
    draw, rows, true = random.Random(5), [], set()
    for i in range(60):
        person, place = f"P{i}", f"L{i % 20}"
        true.add((person, place, "Live_In"))
        for between in draw.sample(["in", "resident of", "of", "born in"], 2):
            rows += [(i, person, place, "PERSON", between, "LOCATION")] * 2
        rows.append((i, person, f"L{draw.randrange(20)}", "PERSON", "and", "LOCATION"))
        rows.append((i, person, f"L{draw.randrange(20)}", "PERSON", "left", "LOCATION"))
    seeds = sorted(true)[:12]
    relations, patterns, _ = learned(spark, rows, seeds)
    assert {k for k, c in relations.items() if c >= 0.5} >= true and len(set(relations) - true) == 0
    assert {p[1] for p in patterns} == {"in", "resident of", "of", "born in"}


def test_rounds_agree_with_plain_sets_and_repeat(spark):
    draw = random.Random(6)
    names, contexts = [f"n{i}" for i in range(9)], [("A", w, "B") for w in "uvwxyz"]
    rows = [(i, draw.choice(names), draw.choice(names), *draw.choice(contexts)) for i in range(150)]
    rows += [(0, None, "n1", "A", "u", "B"), (0, "n1", "n2", None, "u", "B"), (0, "n1", "n2", "A", "", "B")]
    seeds = [("n0", "n1", "R"), ("n1", "n2", "R"), ("n2", "n3", "R"), ("n3", "n4", "S"), ("n4", "n5", "S"), ("n1", "n2", "S"), (None, "n1", "R"), ("n0", "n1", "R")]
    for options in ({"rounds": 1, "support": 1, "confidence": 0.4}, {"rounds": 8, "support": 1, "confidence": 0.34}):
        found = learned(spark, rows, seeds, **options)
        expected = plain(rows, seeds, **options)
        assert found[:2] == expected and learned(spark, rows, seeds, **options) == found


def test_nothing_known_or_no_pairs(spark):
    rows = [(1, "a", "b", "A", "in", "B")]
    assert learned(spark, rows, []) == ({}, {}, 1)
    assert learned(spark, [], [("a", "b", "R")]) == ({("a", "b", "R"): 1.0}, {}, 1)
