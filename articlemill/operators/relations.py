"""Relations between the entity mentions of a sentence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from articlemill.functions.text import word_tokens
from articlemill.operators.entities import merge_adjacent
from articlemill.operators.lookup import keyed_join
from articlemill.operators.spans import numbered_sentences

NO_RELATION = "_NR"

# Relation types by the types of both mentions and the words between.
RELATION_RULES = [
    ("PERSON", "in", "LOCATION", "Live_In"),
    ("PERSON", "of", "LOCATION", "Live_In"),
    ("PERSON", "from", "LOCATION", "Live_In"),
    ("PERSON", "lives in", "LOCATION", "Live_In"),
    ("PERSON", "of", "ORGANIZATION", "Work_For"),
    ("PERSON", "for", "ORGANIZATION", "Work_For"),
    ("PERSON", "works for", "ORGANIZATION", "Work_For"),
    ("ORGANIZATION", "in", "LOCATION", "OrgBased_In"),
    ("ORGANIZATION", "of", "LOCATION", "OrgBased_In"),
    ("LOCATION", ",", "LOCATION", "Located_In"),
    ("LOCATION", "in", "LOCATION", "Located_In"),
]


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str, str]]) -> DataFrame:
    schema = "left_type string, between string, right_type string, rel_type string"
    return spark.createDataFrame(rules, schema)


def sentence_mentions(
    docs: DataFrame,
    keys: list[str],
    text: str,
    gazetteer: DataFrame,
    max_between: int,
    bound: int | None = None,
) -> DataFrame:
    """Mentions of each sentence, each with the `max_between` tokens that follow it."""
    sentences = numbered_sentences(docs, keys, text)
    tokenised = sentences.select(*keys, "sent_id", word_tokens(F.col("text")).alias("_words"))
    # Shifted copies of the array put each token beside those that follow it.
    shifts = [
        F.slice("_words", F.lit(i + 1), F.size("_words")).alias(f"next{i}")
        for i in range(1, max_between + 1)
    ]
    zipped = F.arrays_zip(F.col("_words"), *shifts)
    following = F.array(*[F.col(f"_token.next{i}") for i in range(1, max_between + 1)])
    rows = tokenised.select(*keys, "sent_id", F.posexplode(zipped).alias("pos", "_token"))
    terms = gazetteer.select(F.col("term").alias("token"), F.col("type").alias("tag"))
    # What follows is put together for known tokens alone.
    found = keyed_join(rows.withColumn("token", F.col("_token._words")), terms, ["token"], "inner", bound=bound)
    known = found.select(*keys, "sent_id", "pos", "token", "tag", F.array_compact(following).alias("after"))
    return merge_adjacent(known, keys + ["sent_id"], "after")


def mentions_with_rest(docs: DataFrame, keys: list[str], text: str, gazetteer: DataFrame, bound: int | None = None) -> DataFrame:
    """Mentions of each sentence, each with all tokens that follow it, in lower case and joined by blanks."""
    sentences = numbered_sentences(docs, keys, text)
    tokenised = sentences.select(*keys, "sent_id", word_tokens(F.col("text")).alias("_words"))
    said = tokenised.select(*keys, "sent_id", "_words", F.lower(F.array_join("_words", " ")).alias("_said"), F.size("_words").alias("_size"))
    rows = said.select(*keys, "sent_id", "_said", "_size", F.posexplode("_words").alias("pos", "token"))
    terms = gazetteer.select(F.col("term").alias("token"), F.col("type").alias("tag"))
    found = keyed_join(rows, terms, ["token"], "inner", bound=bound)
    # No token holds a blank, so counting blanks from the end finds what follows. Case is lowered once a sentence: it does not reach across blanks.
    rest = F.call_function("substring_index", F.col("_said"), F.lit(" "), F.col("pos") + 1 - F.col("_size"))
    known = found.select(*keys, "sent_id", "pos", "token", "tag", rest.alias("rest"))
    return merge_adjacent(known, keys + ["sent_id"], "rest")


def relation_pairs(
    docs: DataFrame,
    keys: list[str],
    text: str,
    gazetteer: DataFrame,
    rules: list[tuple[str, str, str, str]] | None = None,
    bound: int | None = None,
    far: bool = False,
) -> DataFrame:
    """Rows `(keys, sent_id, left_text, rel_type, right_text, ...)` of mentions in one sentence, found in texts.

    With `far` these are all pairs, see `all_pairs`; else those near enough for a rule, see `pairs_of_mentions`.
    """
    wanted = rules or RELATION_RULES
    if far:
        return all_pairs(mentions_with_rest(docs, keys, text, gazetteer, bound), keys, wanted)
    mentions = sentence_mentions(docs, keys, text, gazetteer, most_between(wanted), bound)
    return pairs_of_mentions(mentions, keys, wanted)


def most_between(rules: list[tuple[str, str, str, str]]) -> int:
    return max(len(rule[1].split(" ")) for rule in rules)


def pairs_of_mentions(mentions: DataFrame, keys: list[str], rules: list[tuple[str, str, str, str]] | None = None) -> DataFrame:
    """The pairs of rows of `sentence_mentions`, made with the tokens that follow each as far as the longest rule.

    A rule names the words between two mentions, so a pair has at most as many tokens between
    as the longest rule; mentions may stand between as well. Any other pair would get `_NR`,
    which `related` drops; `all_pairs` makes those too. Each mention looks for mentions that start at one of the few places behind it,
    so the pairs stay linear in the mentions.
    """
    wanted = rules or RELATION_RULES
    max_between = most_between(wanted)
    place = [*keys, "sent_id"]
    # Each mention stands at its own place (step 0) and asks at the few places behind it; both meet in a grouping that finds its
    # rows in place, so mentions are made once.
    step = F.col("step")
    asked = mentions.select(*place, "type", "text", "first", "last", "after", F.explode(F.sequence(F.lit(0), F.lit(max_between + 1))).alias("step"))
    own = F.when(step == 0, F.struct(F.col("text").alias("right_text"), F.col("type").alias("right_type")))
    asking = F.when(step > 0, F.struct(F.col("text").alias("left_text"), F.col("type").alias("left_type"), F.col("first").alias("left_first"), F.slice("after", F.lit(1), step - 1).alias("gap")))
    met = (
        asked.groupBy(*place, F.when(step == 0, F.col("first")).otherwise(F.col("last") + step).alias("right_first"))
        .agg(F.collect_list(own).alias("own"), F.collect_list(asking).alias("asking"))
        .filter((F.size("own") > 0) & (F.size("asking") > 0))
    )
    lefts = met.select(*place, "right_first", "own", F.inline("asking"))
    pairs = lefts.select(
        *place, "left_text", "left_type", F.inline("own"), "left_first", "right_first", F.lower(F.array_join("gap", " ")).alias("between"),
    ).select(*place, "left_text", "left_type", "right_text", "right_type", "left_first", "right_first", "between")
    return typed_pairs(pairs, wanted)


def all_pairs(mentions: DataFrame, keys: list[str], rules: list[tuple[str, str, str, str]] | None = None) -> DataFrame:
    """Every mention of `mentions_with_rest` with every one of its sentence that starts behind it, `_NR` where no rule holds.

    There are as many pairs as a sentence has, each with all words between. A mention meets the names and places of its sentence, not their texts,
    and its pairs leave one by one: a task holds the mentions of a sentence, not its pairs.
    """
    place = [*keys, "sent_id"]
    others = F.collect_list(F.struct(F.col("text").alias("right_text"), F.col("type").alias("right_type"), F.col("first").alias("right_first")))
    met = mentions.withColumn("_others", others.over(Window.partitionBy(*place)))
    behind = F.filter("_others", lambda other: other["right_first"] > F.col("last"))
    lefts = met.select(*place, F.col("text").alias("left_text"), F.col("type").alias("left_type"), F.col("first").alias("left_first"), "last", "rest", F.inline(behind))
    between = F.call_function("substring_index", F.col("rest"), F.lit(" "), F.col("right_first") - F.col("last") - 1)
    pairs = lefts.select(*place, "left_text", "left_type", "right_text", "right_type", "left_first", "right_first", between.alias("between"))
    return typed_pairs(pairs, rules or RELATION_RULES)


def typed_pairs(pairs: DataFrame, rules: list[tuple[str, str, str, str]]) -> DataFrame:
    """Adds the type that a rule gives, else `_NR`."""
    by_rule = ["left_type", "between", "right_type"]
    typed = keyed_join(pairs, rule_table(pairs.sparkSession, rules), by_rule, "left", bound=len(rules))
    return typed.withColumn("rel_type", F.coalesce("rel_type", F.lit(NO_RELATION)))


def related(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("rel_type") != NO_RELATION)


def relation_text(left: Column, rel_type: Column, right: Column) -> Column:
    return F.concat_ws(" ", left, F.lit("("), rel_type, F.lit(")"), right)
