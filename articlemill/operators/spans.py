"""Character spans `(begin, end, text)` of pattern matches, 0-based, end exclusive."""

from __future__ import annotations

import sys
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articlemill.functions.text import NON_SPACE, SENTENCE, sentences
from articlemill.sources.tables import by_document, spread

# Tasks carry this module along, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def running_sums(sizes: pa.Array) -> pa.Array:
    """The running sums of each array, for a whole batch at once."""
    sizes = sizes.cast(pa.list_(pa.int32()))
    flat = sizes.flatten().to_numpy(zero_copy_only=False)
    lengths = sizes.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    sums = np.concatenate([[0], np.cumsum(flat, dtype=np.int64)])
    flat_sums = sums[1:] - np.repeat(sums[ends - lengths], lengths)
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(flat_sums.astype(np.int32)), mask=sizes.is_null())


def located(df: DataFrame, hits: Column, gaps: Column) -> DataFrame:
    """Adds `_hits` and `_ends`: the matches of a row's text and where each ends.

    Splitting on a pattern gives the gaps between its matches, so an end is a running sum
    of lengths. All of it happens inside the row: nothing is shuffled or sorted.
    """
    size = F.zip_with("_hits", "_gaps", lambda h, g: F.when(h.isNotNull(), F.length(g) + F.length(h)))
    found = df.withColumn("_hits", hits).withColumn("_gaps", gaps)
    sized = found.withColumn("_sizes", F.filter(size, lambda s: s.isNotNull())).drop("_gaps")
    return sized.withColumn("_ends", running_sums("_sizes")).drop("_sizes")


def match_arrays(docs: DataFrame, keys: list[str], text: str, pattern: str) -> DataFrame:
    """Rows `(keys, _hits, _ends)`, one for each text. Few splits are spread over the cores first."""
    source = spread(docs.select(*keys, text), *keys)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return located(source, hits, F.split(text, pattern)).select(*keys, "_hits", "_ends")


def match_spans(
    docs: DataFrame, keys: list[str], text: str, pattern: str, position: str = "pos"
) -> DataFrame:
    """Rows `(keys, position, begin, end, text)`, one for each match of `pattern`."""
    arrays = match_arrays(docs, keys, text, pattern)
    pairs = F.arrays_zip(F.col("_hits"), F.col("_ends"))
    rows = arrays.select(*keys, F.posexplode(pairs).alias(position, "_span"))
    hit, end = F.col("_span._hits"), F.col("_span._ends")
    return rows.select(*keys, position, (end - F.length(hit)).alias("begin"), end.alias("end"), hit.alias("text"))


def pattern_spans(
    docs: DataFrame,
    keys: list[str],
    text: str,
    patterns: dict[str, str],
    needs: dict[str, str] | None = None,
) -> DataFrame:
    """Rows `(keys, type, begin, end, text)` for every named pattern, in one scan.

    `needs` may give characters of which a text with a match holds at least one; to look
    for these is cheaper than to search for the pattern. Texts that can hold no match of
    any pattern leave first.
    """
    matched = pattern_matches(docs, keys, text, patterns, needs)
    arrays = located(matched, F.col("_found"), F.col("_between")).select(*keys, "type", "_hits", "_ends")
    rows = arrays.select(*keys, "type", F.explode(F.arrays_zip("_hits", "_ends")).alias("_span"))
    hit, end = F.col("_span._hits"), F.col("_span._ends")
    return rows.select(*keys, "type", (end - F.length(hit)).alias("begin"), end.alias("end"), hit.alias("text"))


def pattern_texts(
    docs: DataFrame, keys: list[str], text: str, patterns: dict[str, str], needs: dict[str, str] | None = None
) -> DataFrame:
    """Rows `(keys, type, text)` as `pattern_spans`, without offsets and the Python that finds them."""
    return pattern_matches(docs, keys, text, patterns, needs, between=False).select(*keys, "type", F.explode("_found").alias("text"))


def pattern_matches(
    docs: DataFrame, keys: list[str], text: str, patterns: dict[str, str], needs: dict[str, str] | None, between: bool = True
) -> DataFrame:
    """Rows `(keys, type, _found, _between)`: the matches of each pattern in a text that has any, and the gaps if asked for."""
    possible = {}
    for kind, pattern in patterns.items():
        chars = (needs or {}).get(kind)
        tests = [F.col(text).contains(c) for c in chars] if chars else [F.col(text).rlike(pattern)]
        possible[kind] = reduce(or_, tests)
    candidates = docs.select(*keys, text).filter(reduce(or_, possible.values()))
    each = F.array(*[
        F.struct(
            F.lit(kind).alias("type"),
            F.when(possible[kind], F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("_found"),
            *([F.when(possible[kind], F.split(text, pattern)).alias("_between")] if between else []),
        )
        for kind, pattern in patterns.items()
    ])
    return candidates.select(*keys, F.inline(each)).filter(F.size("_found") > 0)


def token_spans(docs: DataFrame, keys: list[str], text: str) -> DataFrame:
    return match_spans(docs, keys, text, NON_SPACE)


def sentence_spans(docs: DataFrame, keys: list[str], text: str) -> DataFrame:
    return match_spans(docs, keys, text, SENTENCE, position="sent_id")


def numbered_sentences(docs: DataFrame, keys: list[str], text: str, placed: bool = True) -> DataFrame:
    """Rows `(keys, sent_id, text)` without offsets.

    `placed` puts documents by key first, so that later windows by document or sentence find
    their rows in place.
    """
    rows = docs.select(*keys, text)
    source = by_document(rows, *keys) if placed else spread(rows, *keys)
    return source.select(*keys, F.posexplode(sentences(F.col(text))).alias("sent_id", "text"))

