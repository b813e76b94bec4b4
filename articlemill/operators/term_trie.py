"""Known terms of any number of words, the longest match from the left, by a trie of tokens.

A task reads a text token by token and walks the trie from each token that starts a term. A list of terms of
more than SHARD_BYTES is dealt over several tries, one pass over the texts each; what they find meets by document, where the
leftmost and then the longest match goes first, as in a single trie.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articlemill.sources.tables import spread

# Tasks carry this module along, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of letters and digits, and single marks; the same tokens as `functions.text.WORD_OR_MARK`.
TOKEN = re.compile("[^\\W_]+|[^ \\t\\r\\n]")
#: Characters of terms in one trie, which takes some 50 times as many bytes of a worker.
SHARD_BYTES = 4 << 20
OUT_ROWS = 10_000


class TermTrie:
    """Nested tables of tokens; the types of a term are at None below its last token."""

    def __init__(self, terms: Iterable[tuple[str | None, str | None]]):
        self.root: dict = {}
        for term, kind in terms:
            node = self.root
            for token in TOKEN.findall(term or ""):
                node = node.setdefault(token, {})
            if node is not self.root:
                node[None] = tuple(sorted({*node.get(None, ()), kind}, key=lambda k: (k is None, k)))

    def longest_at(self, text: str, first: re.Match) -> tuple[int, tuple] | None:
        """The end and the types of the longest term that starts with a token of the text."""
        node, end, best = self.root.get(first[0]), first.end(), None
        while node is not None:
            if None in node:
                best = end, node[None]
            following = TOKEN.search(text, end)
            if following is None:
                break
            node, end = node.get(following[0]), following.end()
        return best

    def matches(self, text: str, overlapping: bool = False) -> Iterator[tuple[int, int, tuple]]:
        """Begin, end and types of matches from the left, each the longest at its place; none begins inside another unless asked for."""
        known, covered = self.root, 0
        for token in TOKEN.finditer(text):
            if token[0] in known and token.start() >= covered:
                found = self.longest_at(text, token)
                if found:
                    yield token.start(), *found
                    covered = covered if overlapping else found[0]


def in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == OUT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def streamed(df: DataFrame, schema: T.StructType, rows: Callable[[Iterator[tuple]], Iterator[tuple]]) -> DataFrame:
    """Rows of a partition through a function of Python that keeps their order."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))
        yield from in_batches(rows(each), arrow)

    return df.mapInArrow(run, schema)


def not_covered(rows: Iterator[tuple], width: int) -> Iterator[tuple]:
    """Of rows `(keys, type, begin, end, text)` by key, begin and falling end: those that do not begin inside a kept one, and equal spans of other types."""
    key = kept = None
    for row in rows:
        begin, end = row[width + 1], row[width + 2]
        if key != row[:width]:
            key, kept = row[:width], (-1, 0)
        if (begin, end) == kept or begin >= kept[1]:
            kept = begin, end
            yield row


def shard_count(gazetteer: DataFrame) -> int:
    size = gazetteer.agg(F.sum(F.length("term"))).first()[0] or 0
    return max(1, -(-size // SHARD_BYTES))


def term_spans(docs: DataFrame, keys: list[str], text: str, gazetteer: DataFrame, bound: int | None = None) -> DataFrame:
    """Rows `(keys, type, begin, end, text)`: where terms of `(term, type)` stand, of any number of words.

    A term's tokens must follow each other; what parts them does not matter. From the left, the longest term counts, and the next may
    begin where it ends; a term of several types gives a row for each. Null and blank terms match nothing, a null text has no rows.
    Documents are rows with different keys. `bound`, a number of terms known to be small, spares the pass that measures them.
    With one trie nothing is shuffled.
    """
    schema = T.StructType([*[docs.schema[k] for k in keys], *T.StructType.fromDDL("type string, begin int, end int, text string").fields])
    shards = 1 if bound is not None and bound <= 10_000 else shard_count(gazetteer)
    source, width = spread(docs.select(*keys, text), *keys), len(keys)

    def found_by(shard: int) -> DataFrame:
        of_shard = gazetteer.select("term", "type") if shards == 1 else gazetteer.select("term", "type").filter(F.pmod(F.xxhash64("term"), F.lit(shards)) == shard)
        sent = docs.sparkSession.sparkContext.broadcast([(r["term"], r["type"]) for r in of_shard.distinct().toArrow().to_pylist()])

        def rows(each: Iterator[tuple]) -> Iterator[tuple]:
            trie = TermTrie(sent.value)
            for *key, whole in each:
                for begin, end, kinds in trie.matches(whole or "", shards > 1):
                    for kind in kinds:
                        yield *key, kind, begin, end, whole[begin:end]

        return streamed(source, schema, rows)

    found = reduce(DataFrame.unionByName, [found_by(s) for s in range(shards)])
    if shards == 1:
        return found
    placed = found.repartition(*keys).sortWithinPartitions(*keys, "begin", F.desc("end"), "type")
    return streamed(placed, schema, lambda rows: not_covered(rows, width))
