"""The heaviest set of spans that do not overlap, document by document.

Where taggers disagree, ranks let one span of a trusted tagger push out several others. Here each span has a weight, and the set of spans
without overlap that weighs most is kept. Spans are sorted by document and begin; wherever no earlier span reaches, what came before is decided on
its own, so a task holds one run of overlapping spans at a time.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlemill.operators.term_trie import streamed

# Tasks carry this module along, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def heaviest(spans: list[tuple[int, int, float]]) -> list[int]:
    """Places of the heaviest set without overlap among `(begin, end, weight)`.

    By end, a span is taken if it and the best set before its begin weigh more than the best set without it; so of equal sets, the one
    of earlier spans stays. Spans without weight are never taken.
    """
    order = sorted(range(len(spans)), key=lambda i: (spans[i][1], spans[i][0], i))
    ends = [spans[i][1] for i in order]
    best, before = [0.0], []
    for j, i in enumerate(order):
        begin, _, weight = spans[i]
        before.append(bisect_right(ends, begin, 0, j))
        best.append(max(best[j], best[before[j]] + weight))
    chosen, j = [], len(order)
    while j:
        if best[j] > best[j - 1]:
            chosen.append(order[j - 1])
            j = before[j - 1]
        else:
            j -= 1
    return chosen[::-1]


def decided(rows: Iterator[tuple], width: int, begin: int, end: int, weight: int) -> Iterator[tuple]:
    held: list[tuple] = []
    reach = 0

    def kept() -> Iterator[tuple]:
        yield from (held[i] for i in heaviest([(r[begin], r[end], r[weight] or 0) for r in held]))

    for row in rows:
        if held and (row[:width] != held[0][:width] or row[begin] >= reach):
            yield from kept()
            held = []
        reach = max(reach, row[end]) if held else row[end]
        held.append(row)
    yield from kept()


def heaviest_spans(spans: DataFrame, keys: list[str], weight: str = "weight") -> DataFrame:
    """The rows of the heaviest set of each document among `(keys, begin, end, weight, ...)`; all columns stay.

    Rows with a null begin or end are left out, a null weight counts as none. Of equal spans the one first in the order of all its
    columns is kept. One shuffle by key.
    """
    rest = [c for c in spans.columns if c not in keys]
    rows = spans.filter("begin IS NOT NULL AND end IS NOT NULL").select(*keys, *rest)
    order = ["begin", "end", F.desc(weight), *[c for c in rest if c not in ("begin", "end", weight)]]
    placed = rows.repartition(*keys).sortWithinPartitions(*keys, *order)
    at = [len(keys) + rest.index(c) for c in ("begin", "end", weight)]
    return streamed(placed, placed.schema, lambda each: decided(each, len(keys), *at)).select(*spans.columns)


def combine_by_weight(taggers: list[tuple[DataFrame, Column]], keys: list[str]) -> DataFrame:
    """Rows `(keys, type, begin, end, text, weight)`: the heaviest set among the spans of several taggers, each with the weight of its spans."""
    each = [spans.select(*keys, "type", "begin", "end", "text", weight.cast("double").alias("weight")) for spans, weight in taggers]
    return heaviest_spans(reduce(DataFrame.unionByName, each), keys)
