"""Sentences whose ends know abbreviations, learned from the texts themselves.

A period after a word is no end of a sentence if the word is an abbreviation. Such a word is one whose period
comes along nearly always: the log-likelihood ratio of "a period follows with 0.99" against "it follows as it follows any word",
scaled down for long words and for each occurrence without a period, and up for inner periods. After an abbreviation a sentence
starts nevertheless if the next word, here with a capital, is one that the texts mostly write in lower case.

The words are counted by Spark in one pass. What goes to the tasks are words that have a fixed share of all
words, so a bounded number; sentences are cut where the texts are.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articlemill.operators.batches import sliced
from articlemill.sources.tables import spread

# Tasks carry this module along, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A word with what may stand inside or right behind it. One class, as Java matches repeated groups by recursion.
WORD = "[\\p{L}\\p{N}][\\p{L}\\p{N}.'-]*"
INNER = ".'-"
#: How surely a period follows an abbreviation, and the score from which on a word is one.
SURE, THRESHOLD = 0.99, 0.3
#: Share of all words that a word needs to be learned as an abbreviation or as a usual start: at most 1,000,000 words.
WORD_SHARE = 1e-6
#: End marks with what may close a quotation or bracket, at the end of a run without blanks.
END = re.compile("([.!?…]+)[\"')\\]”’»]*(?=[ \t\r\n]|$)")
BLANKS = " \t\r\n"
OPENERS = BLANKS + "\"'([“‘«-"


def word_statistics(docs: DataFrame, text: str) -> DataFrame:
    """`(word, n, n_period, n_lower, score)` of every word of all texts, in lower case.

    `n_period` counts occurrences before a single period, `n_lower` those that start in lower case. The score is null for words never before a period.
    """
    hits = docs.select(F.explode(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).alias("hit"))
    trimmed = hits.select("hit", F.rtrim("hit", F.lit(INNER)).alias("form"))
    period = (F.right("hit", F.lit(1)) == ".") & (F.right("hit", F.lit(2)) != "..")
    each = trimmed.select(F.lower("form").alias("word"), period.cast("bigint").alias("period"), (F.left("form", F.lit(1)) == F.lower(F.left("form", F.lit(1)))).cast("bigint").alias("low"))
    counts = each.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("period").alias("n_period"), F.sum("low").alias("n_lower"))
    # One row: the share of all words that a period follows.
    rate = counts.agg(F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), F.sum("n_period") / F.sum("n"))).alias("rate"))
    n, k = F.col("n"), F.col("n_period")
    ratio = 2 * (k * (F.log(F.lit(SURE)) - F.log("rate")) + (n - k) * (F.log(F.lit(1 - SURE)) - F.log(1 - F.col("rate"))))
    periods = F.length("word") - F.length(F.translate("word", ".", ""))
    length = F.length("word") - periods
    score = ratio * F.exp(-length.cast("double")) * (periods + 1) * F.pow(length.cast("double"), -(n - k).cast("double"))
    scored = counts.join(F.broadcast(rate)).withColumn("score", F.when(k > 0, F.round(score, 6) + 0.0))
    return scored.select("word", "n", "n_period", "n_lower", "score")


@dataclass(frozen=True)
class EndModel:
    abbreviations: frozenset[str]
    starters: frozenset[str]  #: words written in lower case for the most part


def fit_ends(statistics: DataFrame, share: float = WORD_SHARE) -> EndModel:
    """The abbreviations, and the words mostly in lower case, that have a share of all words. `statistics` is read twice: store it if it is large."""
    total = statistics.agg(F.sum("n")).first()[0] or 0
    often = statistics.filter(F.col("n") >= share * total)
    abbreviations = F.coalesce(F.col("score") >= THRESHOLD, F.lit(False))
    kinds = often.select("word", abbreviations.alias("abbreviation"), (2 * F.col("n_lower") > F.col("n")).alias("starter"))
    rows = kinds.filter("abbreviation OR starter").toArrow().to_pylist()
    return EndModel(frozenset(r["word"] for r in rows if r["abbreviation"]), frozenset(r["word"] for r in rows if r["starter"]))


def word_before(text: str, stop: int) -> str:
    start = stop
    while start and (text[start - 1].isalnum() or text[start - 1] in INNER):
        start -= 1
    return text[start:stop].lstrip(INNER).rstrip(INNER)


def is_end(text: str, marks: str, start: int, stop: int, model: EndModel) -> bool:
    """Whether a sentence ends with the marks between `start` and what closes at `stop`."""
    if set(marks) - {".", "…"}:
        return True
    at = stop
    while at < len(text) and text[at] in OPENERS:
        at += 1
    if at == len(text):
        return True
    word = word_before(text, start)
    if marks == ".":
        initial = len(word) == 1 and word.isupper()
        if not initial and word.lower() not in model.abbreviations:
            return True
    if not text[at].isupper():
        return False
    if marks != ".":
        return True
    end = at
    while end < len(text) and (text[end].isalnum() or text[end] in INNER):
        end += 1
    return text[at:end].rstrip(INNER).lower() in model.starters


def sentence_spans_of(text: str, model: EndModel) -> Iterator[tuple[int, int]]:
    """Begin and end of each sentence, without the blanks around it."""
    begin = 0
    for hit in END.finditer(text):
        if is_end(text, hit[1], hit.start(), hit.end(), model):
            yield begin, hit.end()
            begin = hit.end()
    yield begin, len(text)


def learned_sentences(docs: DataFrame, keys: list[str], text: str, model: EndModel) -> DataFrame:
    """Rows `(keys, sent_id, begin, end, text)`, offsets 0-based and exclusive at the end.

    Sentences hold every character but the blanks around them. A null or blank text has no rows. One scan, no shuffle.
    """
    more = "sent_id int, begin int, end int, text string"
    schema = T.StructType([*[docs.schema[k] for k in keys], *T.StructType.fromDDL(more).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in sliced(b, b.num_columns - 1)):
            found: list[tuple] = []
            for row, whole in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                place = 0
                for a, b in sentence_spans_of(whole or "", model):
                    words = whole[a:b].strip(BLANKS) if whole else ""
                    if words:
                        a = whole.index(words, a)
                        found.append((row, place, a, a + len(words), words))
                        place += 1
            columns = list(zip(*found, strict=True)) or [[]] * 5
            kept = [c.take(pa.array(columns[0], pa.int64())) for c in batch.columns[: len(keys)]]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array(c, k) for c, k in zip(columns[1:], kinds, strict=True)]], [f.name for f in schema])

    return spread(docs.select(*keys, text), *keys).mapInArrow(run, schema)
