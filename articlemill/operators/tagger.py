"""A hidden Markov tagger: tags by context, and probabilities of tags and spans.

The model is counted from tokens that another tagger has tagged, sentence by sentence: how often a tag follows a
tag, and how often a tag bears a word. A word that has a fixed share of all tokens stands for itself; others,
and words never seen, stand for their shape, so that an unseen name is tagged by its form and its neighbours. The model's
size is bounded by the share and goes to the tasks; sentences are decoded where they are, many at a time.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articlemill.functions.text import word_tokens
from articlemill.operators.lookup import keyed_join
from articlemill.operators.spans import numbered_sentences, sentence_spans
from articlemill.sources.scratch import written

# Tasks carry this module along, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NO_TAG = "O"
#: What stands before the first and after the last token of a sentence.
EDGE = "|"
#: Share of all tokens from which on a word stands for itself: at most 1,000,000 words.
WORD_SHARE = 1e-6
#: Added to every count of a transition, and of a word or shape under a tag.
SMOOTHING = 0.1
#: Marks the shapes among the words; no word holds a blank.
SHAPE = " "
#: Tokens that are decoded at a time, unless one sentence has more.
PIECE = 1 << 18


def shape(token: Column) -> Column:
    """The form of a word: kinds of letters, digits and marks, runs as one, and the last two letters of longer words in lower case."""
    kinds = F.regexp_replace(token, "\\p{Lu}+", "A")
    for pattern, kind in (("[^\\p{N}\\P{L}A]+", "a"), ("\\p{N}+", "0"), ("[^Aa0]+", "-")):
        kinds = F.regexp_replace(kinds, pattern, kind)
    ending = F.when((F.length(token) > 4) & token.rlike("^\\p{L}+$"), F.lower(F.right(token, F.lit(2))))
    return F.concat(F.lit(SHAPE), kinds, F.coalesce(F.concat(F.lit(SHAPE), ending), F.lit("")))


def ascii_shape(token: str) -> str:
    """The same as `shape` for a token of ASCII characters."""
    kinds = token
    for pattern, kind in (("[A-Z]+", "A"), ("[a-z]+", "a"), ("[0-9]+", "0"), ("[^Aa0]+", "-")):
        kinds = re.sub(pattern, kind, kinds)
    return SHAPE + kinds + (SHAPE + token[-2:].lower() if len(token) > 4 and token.isalpha() else "")


def other_shapes(tokens: Column) -> Column:
    """The shapes of tokens with other characters than ASCII, whose classes Java knows; null for the others, whose shapes few words need."""
    return F.transform(tokens, lambda t: F.when(F.octet_length(t) > F.length(t), shape(t)))


def tagged_sentences(docs: DataFrame, keys: list[str], text: str, gazetteer: DataFrame, bound: int | None = None) -> DataFrame:
    """Rows `(keys, sent_id, pos, token, tag)` of every token of every sentence, tagged by a gazetteer `(term, type)`."""
    rows = numbered_sentences(docs, keys, text)  # placed by document, for the windows of transition_counts
    tokens = rows.select(*keys, "sent_id", F.posexplode(word_tokens(F.col("text"))).alias("pos", "token"))
    terms = gazetteer.select(F.col("term").alias("token"), F.col("type").alias("_type"))
    tagged = keyed_join(tokens, terms, ["token"], "left", bound=bound)
    return tagged.select(*keys, "sent_id", "pos", "token", F.coalesce("_type", F.lit(NO_TAG)).alias("tag"))


def transition_counts(tagged: DataFrame, keys: list[str]) -> DataFrame:
    """`(tag, next, n)` over all sentences; EDGE stands before the first and after the last token."""
    along = Window.partitionBy(*keys, "sent_id").orderBy("pos")
    pairs = tagged.select("tag", F.lag("tag", 1, EDGE).over(along).alias("before"), F.lead("pos").over(along).isNull().alias("last"))
    steps = F.array(F.struct(F.col("before").alias("tag"), F.col("tag").alias("next")), F.when(F.col("last"), F.struct(F.col("tag").alias("tag"), F.lit(EDGE).alias("next"))))
    each = pairs.select(F.inline(F.filter(steps, lambda s: s.isNotNull())))
    return each.groupBy("tag", "next").agg(F.count(F.lit(1)).alias("n"))


def word_counts(tagged: DataFrame) -> DataFrame:
    """`(tag, token, n)` over all tokens."""
    return tagged.groupBy("tag", "token").agg(F.count(F.lit(1)).alias("n"))


def emission_counts(words: DataFrame, share: float = WORD_SHARE, least: int = 2) -> DataFrame:
    """`(tag, word, n)`: words that have `share` of all tokens and at least `least`, and the shapes that stand for the others.

    The shape of every rare word counts under the word's tag, as its word will count when it is tagged. Shapes that do not
    have the share themselves count as one, SHAPE alone, so there are at most 2 / `share` words and shapes.
    """
    # One row: all tokens.
    total = F.broadcast(words.agg(F.sum("n").alias("total")))
    each = words.groupBy("token").agg(F.sum("n").alias("all"))
    enough = F.col("all") >= F.greatest(F.lit(float(least)), F.lit(share) * F.col("total"))
    frequent = each.join(total, enough).select("token", F.lit(True).alias("_own"))
    named = words.join(frequent, "token", "left").withColumn("word", F.coalesce(F.when(F.col("_own"), F.col("token")), shape(F.col("token"))))
    counts = named.groupBy("tag", "word").agg(F.sum("n").alias("n"))
    rare = counts.groupBy("word").agg(F.sum("n").alias("all")).join(total, F.col("all") < F.lit(share) * F.col("total")).select("word", F.lit(True).alias("_rare"))
    merged = counts.join(rare, "word", "left").withColumn("word", F.when(F.col("_rare"), F.lit(SHAPE)).otherwise(F.col("word")))
    return merged.groupBy("tag", "word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class TagModel:
    """Logarithms of probabilities. `steps[i, j]`: tag j after tag i, where the last row and column stand for the edge; `words`: a row of `chances` for each
    word and shape, the last row for shapes never seen where there are no rare ones."""

    tags: list[str]
    steps: np.ndarray
    words: dict[str, int]
    chances: np.ndarray


def model_of(transitions: list[tuple[str, str, int]], emissions: list[tuple[str, str, int]], smoothing: float = SMOOTHING) -> TagModel:
    """The model that follows from counts `(tag, next, n)` and `(tag, word, n)`; every count is raised by `smoothing`."""
    tags = sorted({t for t, _, _ in emissions} | {NO_TAG})
    place = {t: i for i, t in enumerate([*tags, EDGE])}
    steps = np.full((len(place), len(place)), smoothing)
    steps[-1, -1] = 0  # every sentence has a token
    for tag, after, n in transitions:
        steps[place[tag], place[after]] += n
    steps = np.log(np.maximum(steps, 1e-300)) - np.log(steps.sum(axis=1, keepdims=True))
    words = {w: i for i, w in enumerate(sorted({w for _, w, _ in emissions}))}
    chances = np.full((len(words) + 1, len(tags)), smoothing)
    for tag, word, n in emissions:
        chances[words[word], place[tag]] += n
    return TagModel(tags, steps, words, np.log(chances) - np.log(chances.sum(axis=0)))


def fit_tagger(tagged: DataFrame, keys: list[str], share: float = WORD_SHARE, smoothing: float = SMOOTHING) -> TagModel:
    """Counts the model from rows `(keys, sent_id, pos, token, tag)`. Its size is bounded by the share."""
    transitions = [tuple(r) for r in transition_counts(tagged, keys).collect()]
    # The counts are read several times: the texts are tokenised once for them.
    emissions = [tuple(r) for r in emission_counts(written(word_counts(tagged), "tag_words"), share).collect()]
    return model_of(transitions, emissions, smoothing)


class Block:
    """Sentences of one batch, the longest first, so that those still going on at a place are the first ones."""

    def __init__(self, model: TagModel, rows: list[np.ndarray]):
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.order = np.argsort(-self.sizes, kind="stable")
        self.longest = int(self.sizes.max(initial=0))
        self.alive = [int((self.sizes > k).sum()) for k in range(self.longest)]
        words = np.zeros((len(rows), self.longest), np.int64)
        for i, r in enumerate(self.order):
            words[i, : self.sizes[r]] = rows[r]
        self.words, self.model, self.tags = words, model, len(model.tags)

    def chance(self, k: int) -> np.ndarray:
        return self.model.chances[self.words[: self.alive[k], k]]

    def placed(self, values: np.ndarray) -> list[np.ndarray]:
        """The rows of each sentence, in the order given."""
        found = [None] * len(self.sizes)
        for i, r in enumerate(self.order):
            found[r] = values[i, : self.sizes[r]]
        return found

    def best(self) -> list[np.ndarray]:
        """The likeliest sequence of tags of each sentence; of equal ones at a place, the first tag in order."""
        steps, n = self.model.steps, self.tags
        back = np.zeros((len(self.sizes), self.longest, n), np.int16)
        score = np.zeros((len(self.sizes), n))
        for k, now in enumerate(self.alive):
            if k == 0:
                score[:now] = steps[-1, :n] + self.chance(0)
                continue
            ways = score[:now, :, None] + steps[:n, :n]
            back[:now, k] = ways.argmax(axis=1)
            score[:now] = ways.max(axis=1) + self.chance(k)
        found = np.zeros((len(self.sizes), self.longest), np.int64)
        ends = np.arange(len(self.sizes))
        found[ends, np.maximum(self.sizes[self.order] - 1, 0)] = (score + steps[:n, -1]).argmax(axis=1)
        for k in range(self.longest - 1, 0, -1):
            some = ends[: self.alive[k]]
            found[some, k - 1] = back[some, k, found[some, k]]
        return self.placed(found)

    def marginals(self) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray], np.ndarray]:
        """For each sentence: logarithms of what leads to each tag, of what follows it, and of the tag's chance to bear its token; then of the sentence's chance."""
        steps, n = self.model.steps, self.tags
        ahead, behind, chances = (np.zeros((len(self.sizes), self.longest, n)) for _ in range(3))
        for k, now in enumerate(self.alive):
            chances[:now, k] = self.chance(k)
            before = steps[-1, :n] if k == 0 else np.logaddexp.reduce(ahead[:now, k - 1, :, None] + steps[:n, :n], axis=1)
            ahead[:now, k] = before + chances[:now, k]
        for k in range(self.longest - 1, -1, -1):
            now, on = self.alive[k], self.alive[k + 1] if k + 1 < self.longest else 0
            behind[on:now, k] = steps[:n, -1]
            if on:
                after = chances[:on, k + 1] + behind[:on, k + 1]
                behind[:on, k] = np.logaddexp.reduce(steps[:n, :n] + after[:, None, :], axis=2)
        whole = np.zeros(len(self.sizes))
        whole[self.order] = np.logaddexp.reduce(ahead[:, 0] + behind[:, 0], axis=1) if self.longest else 0
        return self.placed(ahead), self.placed(behind), self.placed(chances), whole


def model_rows(tokens: pa.ListArray, shapes: pa.ListArray, model: TagModel) -> list[np.ndarray]:
    """The tokens of each sentence as rows of the model, looked up once for each token of a batch. `shapes` as `other_shapes` gives them."""
    number = model.words.get
    unseen = number(SHAPE, len(model.words))
    flat, forms = tokens.flatten().dictionary_encode(), shapes.flatten()
    places = flat.indices.to_numpy(zero_copy_only=False)
    first = np.zeros(len(flat.dictionary), np.int64)
    first[places[::-1]] = np.arange(len(places))[::-1]
    distinct = zip(flat.dictionary.to_pylist(), forms.take(pa.array(first)).to_pylist(), strict=True)
    rows = [r if (r := number(t)) is not None else number(s if s is not None else ascii_shape(t), unseen) for t, s in distinct]
    sizes = tokens.value_lengths().to_numpy(zero_copy_only=False)
    return np.split(np.array(rows, np.int64)[places], np.cumsum(sizes)[:-1])


def blocks(rows: list[np.ndarray], model: TagModel) -> Iterator[tuple[list[int], Block]]:
    """The sentences that have tokens by about PIECE places each, those of like length together, so that few places are empty."""
    order = sorted((i for i, row in enumerate(rows) if len(row)), key=lambda i: len(rows[i]))
    some: list[int] = []
    for i in order:
        if some and len(rows[i]) * (len(some) + 1) > PIECE:
            yield some, Block(model, [rows[k] for k in some])
            some = []
        some.append(i)
    if some:
        yield some, Block(model, [rows[k] for k in some])


def tokenised(docs: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Rows `(keys, sent_id, tokens, shapes)` of the sentences that have tokens."""
    rows = numbered_sentences(docs, keys, text, placed=False).select(*keys, "sent_id", word_tokens(F.col("text")).alias("tokens"))
    return rows.filter(F.size("tokens") > 0).withColumn("shapes", F.transform("tokens", shape))


def tags_by_context(docs: DataFrame, keys: list[str], text: str, model: TagModel) -> DataFrame:
    """Rows `(keys, sent_id, pos, token, tag)` of every token: the likeliest sequence of tags of each sentence. No shuffle; a null or blank text has no rows."""
    sentences = numbered_sentences(docs, keys, text, placed=False).select(*keys, "sent_id", word_tokens(F.col("text")).alias("tokens"))
    rows = sentences.withColumn("shapes", other_shapes(F.col("tokens")))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("tags", T.ArrayType(T.StringType()))])
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tags = pa.array(model.tags, pa.string())
        for batch in (b for b in batches if b.num_rows):
            *kept, shapes = batch.columns
            found = model_rows(kept[-1], shapes, model)
            sizes = [len(r) for r in found]
            for some, block in blocks(found, model):
                for i, best in zip(some, block.best(), strict=True):
                    found[i] = best
            flat = tags.take(pa.array(np.concatenate(found), pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept, pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), flat)], names)

    tagged = rows.mapInArrow(run, schema)
    each = tagged.select(*keys, "sent_id", F.posexplode(F.arrays_zip("tokens", "tags")).alias("pos", "_t"))
    return each.select(*keys, "sent_id", "pos", F.col("_t.tokens").alias("token"), F.col("_t.tags").alias("tag"))


def token_offsets(text: str, tokens: list[str]) -> list[int]:
    """Where each token starts in its text."""
    starts, at = [], 0
    for token in tokens:
        at = text.index(token, at)
        starts.append(at)
        at += len(token)
    return starts


def runs_of(tags: np.ndarray, none: int) -> list[tuple[int, int, int]]:
    """`(tag, first, last)` of each run of one tag but `none`."""
    edges = np.flatnonzero(np.diff(tags, prepend=-1, append=-1))
    return [(int(tags[a]), int(a), int(b) - 1) for a, b in zip(edges[:-1], edges[1:], strict=True) if tags[a] != none]


def entities_with_probability(docs: DataFrame, keys: list[str], text: str, model: TagModel) -> DataFrame:
    """Rows `(keys, type, begin, end, text, prob, joint)`: runs of one tag in the likeliest sequences, with their place in the text.

    `prob` is the mean over a run's tokens of the probability of its tag there, `joint` the probability that all of
    them bear it; both are over all sequences of tags of the sentence. No shuffle.
    """
    sentences = sentence_spans(docs, keys, text).select(*keys, F.col("begin").alias("_from"), F.col("text").alias("_whole"), word_tokens(F.col("text")).alias("tokens"))
    rows = sentences.withColumn("shapes", other_shapes(F.col("tokens")))
    more = "type string, begin int, end int, text string, prob double, joint double"
    schema = T.StructType([*rows.schema.fields[: len(keys)], *T.StructType.fromDDL(more).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none, steps = model.tags.index(NO_TAG), model.steps
        for batch in (b for b in batches if b.num_rows):
            at, whole_texts, tokens, shapes = batch.columns[len(keys) :]
            numbers = model_rows(tokens, shapes, model)
            found: list[tuple] = []
            for some, block in blocks(numbers, model):
                # Probabilities are needed of the few sentences with a run.
                tagged = [(i, tags) for i, tags in zip(some, block.best(), strict=True) if (tags != none).any()]
                if not tagged:
                    continue
                ahead, behind, chances, whole = Block(model, [numbers[i] for i, _ in tagged]).marginals()
                for i, (row, tags) in enumerate(tagged):
                    sentence, words, start = whole_texts[row].as_py(), tokens[row].as_py(), at[row].as_py()
                    starts = token_offsets(sentence, words)
                    for tag, a, b in runs_of(tags, none):
                        each = np.exp(ahead[i][a : b + 1, tag] + behind[i][a : b + 1, tag] - whole[i])
                        joint = ahead[i][a, tag] + (b - a) * steps[tag, tag] + chances[i][a + 1 : b + 1, tag].sum() + behind[i][b, tag] - whole[i]
                        begin, end = starts[a], starts[b] + len(words[b])
                        prob, joint = (float(min(p, 1)) for p in (each.mean(), np.exp(joint)))
                        found.append((row, model.tags[tag], start + begin, start + end, sentence[begin:end], prob, joint))
            columns = list(zip(*found, strict=True)) or [[]] * 7
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.float64()]
            kept = [c.take(pa.array(columns[0], pa.int64())) for c in batch.columns[: len(keys)]]
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array(c, k) for c, k in zip(columns[1:], kinds, strict=True)]], [f.name for f in schema])

    return rows.mapInArrow(run, schema)
