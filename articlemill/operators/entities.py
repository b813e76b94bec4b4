"""Entity mentions: tagging, merging neighbours, combining taggers, compiling.

A tagger is any table of spans `(keys, type, begin, end, text)`. Two rule taggers are
here, patterns and a gazetteer `(term, type)`; a trained model can take their place
through `mapInPandas`, see `tagged_by`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articlemill.functions.text import WORD_OR_MARK, word_tokens
from articlemill.operators.lookup import keyed_join
from articlemill.operators.spans import match_arrays, numbered_sentences, pattern_spans, pattern_texts
from articlemill.sources.tables import by_document, spread

NO_TAG = "O"

# The entity types.
ENTITY_TYPES = ["LOCATION", "PERSON", "ORGANIZATION", "TIME", "MONEY"]

# Patterns of the rule tagger. None repeats a group of varying length, as Java
# matches such a group by recursion and would overflow on long junk.
ENTITY_PATTERNS = {
    "EMAIL": "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}",
    "IP": "[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}",
    "MONEY": "[$€£][0-9]+(?:,[0-9]{3})*(?:\\.[0-9]+)?",
    "TIME": "[0-9]{4}-[0-9]{2}-[0-9]{2}",
    "NUMBER": "[0-9]+",
}

# Characters of which a text with a match of each pattern holds at least one.
DIGITS = "0123456789"
PATTERN_NEEDS = {"EMAIL": "@", "IP": DIGITS, "MONEY": "$€£", "TIME": DIGITS, "NUMBER": DIGITS}

# Words that start with a capital letter and have at least five letters.
CAPITALISED = "^[A-Z][a-z]{4,}$"


def frequent_gazetteer(
    docs: DataFrame, text: str, n: int, types: list[str], pattern: str = CAPITALISED
) -> DataFrame:
    """A gazetteer from the data: the `n` most frequent words that fit a pattern.

    Types are dealt out by word length, which keeps the table free of a ranking pass.
    """
    words = docs.select(F.explode(word_tokens(F.col(text))).alias("term"))
    names = words.filter(F.col("term").rlike(pattern))
    counts = names.groupBy("term").agg(F.count(F.lit(1)).alias("cnt"))
    top = counts.orderBy(F.desc("cnt"), "term").limit(n)
    kind = F.element_at(
        F.array(*[F.lit(t) for t in types]), (F.length("term") % len(types) + 1).cast("int")
    )
    return top.select("term", kind.alias("type"))


def token_tags(
    docs: DataFrame,
    keys: list[str],
    text: str,
    gazetteer: DataFrame,
    bound: int | None = None,
) -> DataFrame:
    """Rows `(keys, pos, token, tag)` for every token, `O` where nothing is known."""
    tokens = docs.select(*keys, F.posexplode(word_tokens(F.col(text))).alias("pos", "token"))
    terms = gazetteer.select(F.col("term").alias("token"), F.col("type").alias("_type"))
    tagged = keyed_join(tokens, terms, ["token"], "left", bound=bound)
    tag = F.coalesce(F.col("_type"), F.lit(NO_TAG)).alias("tag")
    return tagged.select(*keys, "pos", "token", tag)


def known_tokens(
    docs: DataFrame,
    keys: list[str],
    text: str,
    gazetteer: DataFrame,
    bound: int | None = None,
) -> DataFrame:
    """The tagged rows of `token_tags` alone, for documents placed by key."""
    placed = by_document(docs.select(*keys, text), *keys)
    tokens = placed.select(*keys, F.posexplode(word_tokens(F.col(text))).alias("pos", "token"))
    terms = gazetteer.select(F.col("term").alias("token"), F.col("type").alias("tag"))
    return keyed_join(tokens, terms, ["token"], "inner", bound=bound).select(
        *keys, "pos", "token", "tag"
    )


def merge_adjacent(tags: DataFrame, keys: list[str], *carried: str) -> DataFrame:
    """Joins neighbouring tokens of one tag into mentions `(keys, type, first, last, text)`.

    Untagged tokens are dropped first. Within one tag the difference of position and
    rank is constant along a run, so it names the run; a token tagged twice alike counts
    once. Columns in `carried` are taken from the last token of a run.
    """
    tagged = tags.filter(F.col("tag") != NO_TAG)
    along = Window.partitionBy(*keys, "tag").orderBy("pos")
    runs = tagged.withColumn("_run", F.col("pos") - F.dense_rank().over(along))
    words = F.array_sort(F.collect_set(F.struct("pos", "token")))
    mentions = runs.groupBy(*keys, "tag", "_run").agg(
        F.min("pos").alias("first"),
        F.max("pos").alias("last"),
        F.array_join(F.transform(words, lambda w: w["token"]), " ").alias("text"),
        *[F.max_by(c, "pos").alias(c) for c in carried],
    )
    return mentions.select(*keys, F.col("tag").alias("type"), "first", "last", "text", *carried)


def gazetteer_spans(
    docs: DataFrame,
    keys: list[str],
    text: str,
    gazetteer: DataFrame,
    bound: int | None = None,
    max_words: int = 1,
) -> DataFrame:
    """Rows `(keys, type, begin, end, text)` of known terms of up to `max_words` words.

    A term is compared with every run of that many tokens, joined by single blanks.
    """
    arrays = match_arrays(docs, keys, text, WORD_OR_MARK)
    # Shifted copies of the arrays put each token beside those that follow it.
    shifted = [F.col("_hits").alias("w0"), F.col("_ends").alias("e0")]
    for i in range(1, max_words):
        shifted += [F.slice(c, F.lit(i + 1), F.size(c)).alias(f"{n}{i}") for c, n in (("_hits", "w"), ("_ends", "e"))]
    zipped = arrays.select(*keys, *shifted)
    names = [c for c in zipped.columns if c not in keys]
    tokens = zipped.select(*keys, F.explode(F.arrays_zip(*names)).alias("_t"))
    grams = [
        F.when(F.col(f"_t.w{i}").isNotNull(), F.struct(
            F.concat_ws(" ", *[F.col(f"_t.w{k}") for k in range(i + 1)]).alias("term"), F.col(f"_t.e{i}").alias("end"),
        ))
        for i in range(max_words)
    ]
    begin = F.col("_t.e0") - F.length("_t.w0")
    rows = tokens.select(*keys, begin.alias("begin"), F.inline(F.filter(F.array(*grams), lambda g: g.isNotNull())))
    terms = gazetteer.select("term", "type")
    known = keyed_join(rows, terms, ["term"], "inner", bound=bound)
    return known.select(*keys, "type", "begin", "end", F.col("term").alias("text"))


def entity_spans(
    docs: DataFrame, keys: list[str], text: str, patterns: dict[str, str] | None = None
) -> DataFrame:
    """Spans of the pattern tagger, their text and probability, which rules set to 1."""
    spans = _known_pattern_spans(spread(docs.select(*keys, text), *keys), keys, text, patterns)
    return spans.withColumn("prob", F.lit(1.0))


def tagged_by(
    docs: DataFrame,
    keys: list[str],
    text: str,
    tagger: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
) -> DataFrame:
    """Spans from a user's model: it maps batches `(keys, text)` to batches of spans.

    The function runs once per partition, so it can load a model before its first batch.
    """
    fields = [docs.schema[k] for k in keys] + [
        T.StructField("type", T.StringType()),
        T.StructField("begin", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("text", T.StringType()),
        T.StructField("prob", T.DoubleType()),
    ]
    return docs.select(*keys, text).mapInPandas(tagger, T.StructType(fields))


def entities_by_sentence(
    docs: DataFrame, keys: list[str], text: str, patterns: dict[str, str] | None = None
) -> DataFrame:
    """Rows `(keys, sent_id, type, begin, end, text)`, offsets within the sentence."""
    sentences = numbered_sentences(docs, keys, text, placed=False)
    return _known_pattern_spans(sentences, keys + ["sent_id"], "text", patterns)


def _known_pattern_spans(
    docs: DataFrame,
    keys: list[str],
    text: str,
    patterns: dict[str, str] | None,
) -> DataFrame:
    wanted = patterns or ENTITY_PATTERNS
    return pattern_spans(docs, keys, text, wanted, _needs(wanted))


def _needs(patterns: dict[str, str]) -> dict[str, str]:
    """Characters that a match needs, for those patterns that are the known ones."""
    return {kind: PATTERN_NEEDS[kind] for kind, pattern in patterns.items() if ENTITY_PATTERNS.get(kind) == pattern}


def entity_texts(docs: DataFrame, keys: list[str], text: str, patterns: dict[str, str] | None = None) -> DataFrame:
    """Rows `(keys, type, text)` of the pattern tagger, for uses that need no offsets."""
    wanted = patterns or ENTITY_PATTERNS
    return pattern_texts(spread(docs.select(*keys, text), *keys), keys, text, wanted, _needs(wanted))


def combine_ranked(spans: DataFrame, keys: list[str], rank: Column, levels: int) -> DataFrame:
    """All spans of rank 0; of each later rank those that overlap none kept so far.

    Windows over each document compare a span with the furthest end before it and the
    nearest begin after it, instead of pairing all spans of the document. Every level
    works on the same placed rows, so there is one scan and one shuffle in all.
    """
    ranked = spans.withColumn("_rank", rank).withColumn("_keep", F.col("_rank") == 0)
    # At an equal begin the kept spans count as before. Both frames grow by one row at a
    # time; a frame up to the end of the document would be read anew for every row.
    forward = Window.partitionBy(*keys).orderBy("begin", F.desc("_keep"))
    backward = Window.partitionBy(*keys).orderBy(F.desc("begin"), "_keep")
    before = F.max(F.when(F.col("_keep"), F.col("end"))).over(
        forward.rowsBetween(Window.unboundedPreceding, 0)
    )
    after = F.min(F.when(F.col("_keep"), F.col("begin"))).over(
        backward.rowsBetween(Window.unboundedPreceding, -1)
    )
    for level in range(1, levels):
        marked = ranked.withColumn("_before", before).withColumn("_after", after)
        clear = (F.coalesce(F.col("_before"), F.lit(-1)) <= F.col("begin")) & (
            F.col("_after").isNull() | (F.col("_after") >= F.col("end"))
        )
        keep = F.col("_keep") | ((F.col("_rank") == level) & clear)
        ranked = marked.withColumn("_keep", keep).drop("_before", "_after")
    return ranked.filter("_keep").drop("_rank", "_keep")


def combine_types(spans: DataFrame, keys: list[str], order: list[list[str]]) -> DataFrame:
    """Combines the types of one table of spans, the types of a list before the next list's.

    Types in no list come last.
    """
    ranks = [F.when(F.col("type").isin(kinds), i) for i, kinds in enumerate(order)]
    return combine_ranked(spans, keys, F.coalesce(*ranks, F.lit(len(order))), len(order) + 1)


def combine_taggers(taggers: list[DataFrame], keys: list[str]) -> DataFrame:
    """Combines tables of spans from several taggers, the first the most trusted."""
    ranked = [spans.withColumn("_tagger", F.lit(i)) for i, spans in enumerate(taggers)]
    union = ranked[0]
    for more in ranked[1:]:
        union = union.unionByName(more)
    return combine_ranked(union, keys, F.col("_tagger"), len(taggers)).drop("_tagger")


def of_type(entities: DataFrame, kind: str) -> DataFrame:
    return entities.filter(F.col("type") == kind)


def matching_names(
    entities: DataFrame, kind: str, names: DataFrame, bound: int | None = None
) -> DataFrame:
    """Entities of one type whose text is in a list of names, such as states."""
    listed = names.select(F.col(names.columns[0]).alias("text"))
    return keyed_join(of_type(entities, kind), listed, ["text"], "left_semi", bound=bound)


def merge_aliases(entities: DataFrame, keys: list[str], kind: str = "PERSON") -> DataFrame:
    """Rows `(keys, name, canonical, cnt)` that map a surname to the full name ending with it.

    Of several full names with one surname the longest wins, then the first in order;
    full names stay themselves. Names are counted before they are compared, so the
    window holds each distinct name of a document once.
    """
    names = (
        of_type(entities, kind)
        .groupBy(*keys, F.col("text").alias("name"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    words = F.split("name", " ")
    named = names.withColumn("_last", F.element_at(words, -1)).withColumn("_n", F.size(words))
    best = Window.partitionBy(*keys, "_last").orderBy(
        F.desc("_n"), F.desc(F.length("name")), "name"
    )
    longest = F.first("name").over(
        best.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    merged = named.withColumn("_longest", longest)
    canonical = F.when(F.col("_n") == 1, F.col("_longest")).otherwise(F.col("name"))
    return merged.select(*keys, "name", canonical.alias("canonical"), "cnt")


def compile_entities(
    entities: DataFrame, keys: list[str], types: list[str] | None = None
) -> DataFrame:
    """One row per document with a sorted array of distinct texts for each type."""
    kinds = types or ENTITY_TYPES
    distinct = entities.filter(F.col("type").isin(kinds)).select(*keys, "type", "text").distinct()
    arrays: list[Column] = [
        F.sort_array(F.collect_list(F.when(F.col("type") == kind, F.col("text")))).alias(
            kind.lower()
        )
        for kind in kinds
    ]
    return distinct.groupBy(*keys).agg(*arrays)


def compiled_articles(
    articles: DataFrame,
    keys: list[str],
    title: str,
    entities: DataFrame,
    types: list[str] | None = None,
) -> DataFrame:
    """Every article's title with its entities by type; the arrays are empty if it has none."""
    kinds = [kind.lower() for kind in types or ENTITY_TYPES]
    compiled = compile_entities(entities, keys, types)
    joined = articles.select(*keys, F.col(title).alias("title")).join(compiled, keys, "left")
    nothing = F.array().cast("array<string>")
    return joined.select(*keys, "title", *[F.coalesce(k, nothing).alias(k) for k in kinds])


def compiled_json(compiled: DataFrame, keys: list[str]) -> DataFrame:
    fields = [c for c in compiled.columns if c not in keys]
    return compiled.select(*keys, F.to_json(F.struct(*fields)).alias("json"))
