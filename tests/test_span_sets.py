import itertools
import random

from pyspark.sql import functions as F

from articlemill.operators import span_sets as S


def most(spans):
    """The greatest weight of a set without overlap, by trying all sets."""
    best = 0
    for n in range(len(spans) + 1):
        for some in itertools.combinations(sorted(spans), n):
            if all(a[1] <= b[0] for a, b in itertools.pairwise(some)):
                best = max(best, sum(s[2] for s in some))
    return best


def test_sets_weigh_as_much_as_the_best_of_all_sets(spark):
    draw, rows = random.Random(4), []
    for doc in [*range(60), None]:
        for _ in range(draw.randint(0, 9)):
            begin = draw.randint(0, 30)
            rows.append((doc, "T", begin, begin + draw.randint(0, 8), draw.choice([0, 1, 2, 2, 5, 7, None]), "x"))
    rows += [(99, "T", None, 3, 1, "x"), (98, "T", 0, 2, 3, "x"), (98, "T", 0, 2, 3, "x")]
    df = spark.createDataFrame(rows, "doc_id int, type string, begin int, end int, weight int, text string").repartition(4)
    found = {}
    for r in S.heaviest_spans(df, ["doc_id"]).collect():
        found.setdefault(r.doc_id, []).append((r.begin, r.end, r.weight))
    groups = {}
    for doc, _, begin, end, weight, _ in rows:
        if begin is not None:
            groups.setdefault(doc, []).append((begin, end, weight or 0))
    for doc, spans in groups.items():
        own = sorted(found.get(doc, []))
        assert all(a[1] <= b[0] for a, b in itertools.pairwise(own))
        assert sum(s[2] for s in own) == most(spans), doc
        assert all(s in spans for s in own)
    assert S.heaviest_spans(df.limit(0), ["doc_id"]).count() == 0


def test_equal_sets_have_one_answer():
    spans = [(0, 4, 2.0), (2, 6, 2.0), (4, 8, 2.0), (6, 8, 0.0)]
    assert S.heaviest(spans) == [0, 2]
    assert S.heaviest([(0, 2, 1.0), (0, 2, 1.0)]) == [0]


def test_taggers_by_weight(spark):
    schema = "doc_id int, type string, begin int, end int, text string, prob double"
    a = spark.createDataFrame([(1, "LONG", 0, 10, "0123456789", 1.0)], schema)
    b = spark.createDataFrame([(1, "LEFT", 0, 5, "01234", 1.0), (1, "RIGHT", 5, 10, "56789", 1.0)], schema)
    length = F.col("end") - F.col("begin")
    both = [(a, length * F.col("prob") * 0.9), (b, length)]
    assert sorted(r.type for r in S.combine_by_weight(both, ["doc_id"]).collect()) == ["LEFT", "RIGHT"]
    assert [r.type for r in S.combine_by_weight([(a, length * 2), (b, length)], ["doc_id"]).collect()] == ["LONG"]
