"""A tokenizer that learns where to split, with a probability for each token.

Blanks always part tokens. Between two neighbouring characters that are no blanks a maximum-entropy
model decides, from the classes of the characters around. It learns from texts that someone else has
tokenised: tasks count how often each context is split, the counts are summed by context, and the
weights are fitted to these sums. There is a fixed number of contexts, however many texts there are, so the sums go to the driver.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articlemill.operators.batches import sliced
from articlemill.sources.tables import spread

# Tasks carry this module along, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLANKS = " \t\r\n"
#: Classes of characters: a blank, kinds of letters and numbers, the rest, and each ASCII mark by itself.
KINDS = {"Ll": 1, "Lu": 2, "Lt": 2, "Lm": 3, "Lo": 3, "Nd": 4, "Nl": 5, "No": 5, "Mn": 6, "Mc": 6, "Me": 6}
OTHER, FIRST_MARK = 7, 8
ASCII_MARKS = [chr(b) for b in range(33, 127) if not chr(b).isalnum()]
CLASSES = FIRST_MARK + len(ASCII_MARKS)
#: Further away, all ASCII marks are one class.
COARSE = FIRST_MARK + 1
#: A context is the coarse class before, the classes on both sides, the coarse class after, and whether both sides are the same character.
CONTEXTS = COARSE * CLASSES * CLASSES * COARSE * 2
ROUNDS = 100
#: Characters that a task works on at a time, unless one text has more.
PIECE = 1 << 21


@functools.lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    table = np.array([KINDS.get(unicodedata.category(chr(c)), OTHER) for c in range(sys.maxunicode + 1)], np.uint8)
    for i, mark in enumerate(ASCII_MARKS):
        table[ord(mark)] = FIRST_MARK + i
    table[[ord(b) for b in BLANKS]] = 0
    return table


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def boundaries(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places between two characters that are no blanks (that of the second one), and their contexts."""
    fine = np.concatenate([[0, 0], class_table()[points], [0, 0]]).astype(np.int64)
    coarse = np.minimum(fine, FIRST_MARK)
    at = np.flatnonzero((fine[1:-2] > 0) & (fine[2:-1] > 0))
    at = at[(at > 0) & (at < len(points))]
    same = points[at - 1] == points[at]
    context = coarse[at]
    for part, size in ((fine[at + 1], CLASSES), (fine[at + 2], CLASSES), (coarse[at + 3], COARSE), (same, 2)):
        context = context * size + part
    return at, context


#: Numbers of features of each family.
FAMILIES = [CLASSES**2, CLASSES, CLASSES, COARSE * CLASSES**2, COARSE * CLASSES**2, 2]


def features(context: np.ndarray) -> list[np.ndarray]:
    """Numbers of the features of each context: both sides, each side, each side with what is beyond, and sameness."""
    rest, same = np.divmod(context, 2)
    rest, after = np.divmod(rest, COARSE)
    before, pair = np.divmod(rest, CLASSES * CLASSES)
    left, right = np.divmod(pair, CLASSES)
    numbers = [pair, left, right, before * CLASSES**2 + pair, pair * COARSE + after, same]
    return [number + base for number, base in zip(numbers, np.cumsum([0, *FAMILIES]), strict=False)]


@dataclass(frozen=True)
class SplitModel:
    """`log_odds[f]`: what a feature adds to the log odds of a split."""

    log_odds: np.ndarray

    def split_probability(self, context: np.ndarray) -> np.ndarray:
        odds = sum(self.log_odds[f] for f in features(context))
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def fitted(context: np.ndarray, n: np.ndarray, n_split: np.ndarray, rounds: int = ROUNDS) -> SplitModel:
    """Generalised iterative scaling: the model's expected counts of each feature and outcome approach those seen.

    Every context has as many features, so a step is the logarithm of seen over expected, divided by that number. A tenth of a count
    is added to both, for features that one outcome never has.
    """
    rows = features(context)
    size = sum(FAMILIES)
    weights = np.zeros((2, size))

    def summed(values: np.ndarray) -> np.ndarray:
        return sum(np.bincount(f, values, size) for f in rows)

    seen = [summed(n - n_split), summed(n_split)]
    for _ in range(rounds if len(context) else 0):
        odds = sum(weights[1][f] - weights[0][f] for f in rows)
        split = n / (1 + np.exp(-odds))
        for outcome, expected in enumerate((n - split, split)):
            weights[outcome] += np.log((seen[outcome] + 0.1) / (summed(expected) + 0.1)) / len(rows)
    return SplitModel(weights[1] - weights[0])


def token_starts(text: str, tokens: Iterable[str]) -> list[int]:
    """Where each token starts, taken from the left."""
    starts, at = [], 0
    for token in tokens:
        at = text.index(token, at)
        starts.append(at)
        at += len(token)
    return starts


def joined_pieces(texts: list[str | None]) -> Iterator[tuple[range, str]]:
    """Texts of about PIECE characters in all, joined by line ends, with the places of their rows."""
    start, size = 0, 0
    for i, text in enumerate([*texts, None]):
        size += len(text or "") + 1
        if i == len(texts) or size > PIECE:
            rows = range(start, min(i + 1, len(texts)))
            if len(rows):
                yield rows, "\n".join(t or "" for t in texts[rows.start : rows.stop])
            start, size = rows.stop, 0


def split_counts(docs: DataFrame, text: str, tokens: Column) -> DataFrame:
    """`(context, n, n_split)` over all texts; `tokens` gives the tokens of each, in order. Combined in each task first."""
    rows = docs.select(F.col(text).alias("text"), tokens.alias("tokens")).filter("text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, CONTEXTS), np.int64)
        for part in (p for batch in batches for p in sliced(batch, 0)):
            texts, lists = (c.to_pylist() for c in part.columns)
            for some, whole in joined_pieces(texts):
                points = code_points(whole)
                starts, offset = np.zeros(len(points) + 1, bool), 0
                for i in some:
                    starts[[offset + s for s in token_starts(texts[i], lists[i] or [])]] = True
                    offset += len(texts[i]) + 1
                at, context = boundaries(points)
                counts[0] += np.bincount(context, minlength=CONTEXTS)
                counts[1] += np.bincount(context[starts[at]], minlength=CONTEXTS)
        found = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[0, found]), pa.array(counts[1, found])], ["context", "n", "n_split"])

    parts = rows.mapInArrow(run, "context bigint, n bigint, n_split bigint")
    return parts.groupBy("context").agg(F.sum("n").alias("n"), F.sum("n_split").alias("n_split"))


def fit_splits(docs: DataFrame, text: str, tokens: Column, rounds: int = ROUNDS) -> SplitModel:
    """Learns from the tokens of all given texts. Texts that are null do not count; with none, every split has a chance of one half."""
    rows = split_counts(docs, text, tokens).orderBy("context").toArrow()
    return fitted(*[rows.column(c).to_numpy().astype(kind) for c, kind in (("context", np.int64), ("n", float), ("n_split", float))], rounds)


def agreement(docs: DataFrame, text: str, tokens: Column, model: SplitModel) -> DataFrame:
    """`(n, n_agree)`: boundaries of all texts, and those where the model decides as `tokens` do."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            context, n, n_split = (c.to_numpy() for c in batch.columns)
            yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(np.where(model.split_probability(context) >= 0.5, n_split, n - n_split))], ["n", "n_agree"])

    decided = split_counts(docs, text, tokens).mapInArrow(run, "n bigint, n_agree bigint")
    return decided.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "n_agree")])


def tokenised(points: np.ndarray, model: SplitModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the tokens, and the probability of each: the product over its decisions inside and at its end."""
    if not len(points):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    at, context = boundaries(points)
    p = model.split_probability(context)
    split = p >= 0.5
    solid = class_table()[points] > 0
    before = np.concatenate([[False], solid[:-1]])
    start = solid & ~before
    start[at[split]] = True
    end = before & ~solid  # a token ends before these places
    end[at[split]] = True
    starts = np.flatnonzero(start)
    ends = np.concatenate([np.flatnonzero(end), [len(points)] if solid[-1] else []]).astype(np.int64)
    logs = np.zeros(len(points) + 1)
    logs[at] = np.log(np.where(split, p, 1 - p))
    sums = np.cumsum(logs)
    return starts, ends, np.exp(sums[ends] - sums[starts])


def learned_tokens(docs: DataFrame, keys: list[str], text: str, model: SplitModel) -> DataFrame:
    """Rows `(keys, pos, token, prob)` of every text. One scan, no shuffle; a null or blank text has no rows.

    `prob` is the product of the probabilities of the decisions inside a token and at its end, as far as
    the model takes them: a boundary at a blank is certain.
    """
    fields = [docs.schema[k] for k in keys]
    more = [T.StructField("pos", T.IntegerType()), T.StructField("token", T.StringType()), T.StructField("prob", T.DoubleType())]
    names = [*keys, "pos", "token", "prob"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for whole in batches for p in sliced(whole, whole.num_columns - 1)):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for some, whole in joined_pieces(texts):
                starts, ends, prob = tokenised(code_points(whole), model)
                offsets = np.cumsum([0, *[len(texts[i] or "") + 1 for i in some]])
                row = np.searchsorted(offsets, starts, side="right") - 1
                pos = np.arange(len(starts)) - np.searchsorted(starts, offsets[row])
                tokens = [whole[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                taken = pa.array(row + some.start)
                columns = [*[c.take(taken) for c in batch.columns[: len(keys)]], pa.array(pos, pa.int32()), pa.array(tokens, pa.string()), pa.array(prob)]
                yield pa.RecordBatch.from_arrays(columns, names)

    source = spread(docs.select(*keys, text), *keys)
    return source.mapInArrow(run, T.StructType([*fields, *more]))
