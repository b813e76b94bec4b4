"""Document classification: by dictionary, by word model, by features."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlemill.operators.counts import dictionary_scores, labelled_dictionary
from articlemill.operators.lookup import keyed_join
from articlemill.schemas import DEFAULT_LABEL, NEGATIVE_LABEL
from articlemill.sources.scratch import written
from articlemill.sources.tables import by_document


def training_union(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """Positive and negative articles in one training set `(…, label)`."""
    return positive.withColumn("label", F.lit(DEFAULT_LABEL)).unionByName(
        negative.withColumn("label", F.lit(NEGATIVE_LABEL))
    )


def classify_by_dictionary(
    docs: DataFrame,
    labels: DataFrame,
    key: str,
    token_array: Column,
    n: int,
    threshold: float,
    stopwords: Iterable[str] | DataFrame | None = None,
) -> DataFrame:
    """Labels the documents that `labels` does not name.

    The dictionary holds the top `n` words of those it does name; a document gets the
    positive label if the share of its tokens in the dictionary reaches the threshold.
    """
    dictionary = labelled_dictionary(docs, labels, key, token_array, n, stopwords)
    unlabelled = docs.join(labels.select(key), key, "left_anti")
    scores = dictionary_scores(unlabelled, [key], token_array, dictionary, bound=n)
    label = F.when(F.col("score") >= threshold, DEFAULT_LABEL).otherwise(NEGATIVE_LABEL)
    return scores.withColumn("label", label)


#: Share of all words of the training texts from which on a word is common: at most 100,000 words.
COMMON_SHARE = 1e-5


@dataclass(frozen=True)
class WordModel:
    """Multinomial naive Bayes as tables.

    `words` has a row `(word, likelihood)` per word of the training texts, an entry per category; `common` has those of
    them that have COMMON_SHARE of all words, so a bounded number. The other fields have an entry per category.
    """

    words: DataFrame
    common: DataFrame
    categories: list[float]
    priors: list[float]
    totals: list[float]


def train_document_categoriser(training: DataFrame, smoothing: float = 1.0) -> WordModel:
    """Learns from rows `(tokens array<string>, category double)`; all words count, however many.

    Only the categories, a closed list, and their sums reach the driver.
    """
    sizes = training.groupBy("category").count().filter("category IS NOT NULL").orderBy("category").collect()
    categories = [float(r["category"]) for r in sizes]
    each = training.select("category", F.explode("tokens").alias("word")).filter("word <> ''")
    per_category = [F.count(F.when(F.col("category") == c, 1)).cast("double") for c in categories]
    # Counted once, for the sums here and for the joins of the prediction.
    words = written(each.groupBy("word").agg(F.array(*per_category).alias("counts")), "words")
    sums = [F.coalesce(F.sum(F.get("counts", F.lit(i))), F.lit(0.0)) for i in range(len(categories))]
    row = words.agg(F.count(F.lit(1)), *sums).head()
    documents = sum(r["count"] for r in sizes) + smoothing * len(sizes)
    priors = [math.log(r["count"] + smoothing) - math.log(documents) for r in sizes]
    totals = [math.log(row[i + 1] + smoothing * row[0]) if row[0] else 0.0 for i in range(len(sizes))]
    likelihood = F.transform("counts", lambda n: F.log(n + F.lit(smoothing))).alias("likelihood")
    often = F.aggregate("counts", F.lit(0.0), lambda a, n: a + n) >= COMMON_SHARE * sum(row[1:])
    return WordModel(words.select("word", likelihood), words.filter(often).select("word", likelihood), categories, priors, totals)


def predict_categories(model: WordModel, docs: DataFrame, keys: list[str]) -> DataFrame:
    """Rows `(keys, category, prob)` for documents `(keys, tokens)`.

    Words that the training texts lack are left out of the sum. Words are counted per document where it is; common words meet
    the model there, and only the others are shuffled to the rest of it. A document without known words gets the priors.
    """
    n = len(model.categories)
    placed = by_document(docs, *keys).select(*keys, F.explode_outer("tokens").alias("word"))
    words = placed.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("_n"))

    def summed(rows: DataFrame, *more: Column) -> DataFrame:
        """Adds what known words give to `_matched` and `_s0`, `_s1`, ... of each document."""
        known = F.when(F.col("likelihood").isNotNull(), F.col("_n"))
        sums = [F.coalesce(F.sum(F.col("_n") * F.get("likelihood", F.lit(i))), F.lit(0.0)).alias(f"_s{i}") for i in range(n)]
        return rows.groupBy(*keys).agg(F.coalesce(F.sum(known), F.lit(0)).alias("_matched"), *sums, *more)

    met = words.join(F.broadcast(model.common), "word", "left")
    left_over = F.collect_list(F.when(F.col("likelihood").isNull() & F.col("word").isNotNull(), F.struct("word", "_n")))
    first = summed(met, left_over.alias("_rest"))
    sums = ["_matched", *[f"_s{i}" for i in range(n)]]
    each = first.select(*keys, *[F.col(c).alias(f"_first{c}") for c in sums], F.posexplode_outer("_rest").alias("_pos", "_w"))
    once = [F.when(F.coalesce("_pos", F.lit(0)) == 0, F.col(f"_first{c}")).alias(f"_first{c}") for c in sums]
    # Documents without other words carry a word of their own that no text has, so that they do not meet in one task.
    word = F.coalesce("_w.word", F.concat(F.lit("\0"), F.xxhash64(*keys).cast("string")))
    rest = each.select(*keys, *once, word.alias("word"), F.col("_w._n").alias("_n"))
    known = keyed_join(rest, model.words, ["word"], "left")
    both = summed(known, *[F.sum(f"_first{c}").alias(f"_first{c}") for c in sums])
    totals = both.select(*keys, (F.col("_matched") + F.col("_first_matched")).alias("_matched"), F.array(*[F.col(c) + F.col(f"_first{c}") for c in sums[1:]]).alias("_sums"))
    scores = F.array(*[
        F.lit(model.priors[i]) + F.get("_sums", F.lit(i)) - F.col("_matched") * F.lit(model.totals[i]) for i in range(n)
    ])
    scored = totals.select(*keys, scores.alias("_scores")).withColumn("_best", F.array_max("_scores"))
    place = (F.array_position("_scores", F.col("_best")) - 1).cast("int")
    weight = F.aggregate("_scores", F.lit(0.0), lambda total, s: total + F.exp(s - F.col("_best")))
    category = F.get(F.array(*[F.lit(int(c)) for c in model.categories]), place)
    return scored.select(*keys, category.alias("category"), (1 / weight).alias("prob"))


def train_multinomial(
    matrix: DataFrame, label: str, max_iter: int = 200, reg_param: float = 0.01
) -> PipelineModel:
    """Multinomial logistic regression on rows `(features array<double>, label)`.

    Features are not standardised, so the loss is the mean log loss plus half of
    `reg_param` times the squared coefficients, and `multinomial_gradient` can check the fit.
    """
    vectors = matrix.select(
        array_to_vector(F.col("features")).alias("features"), F.col(label).cast("double").alias("label")
    )
    regression = LogisticRegression(
        family="multinomial", maxIter=max_iter, regParam=reg_param, featuresCol="features",
        standardization=False, tol=1e-8,
    )
    return Pipeline(stages=[regression]).fit(vectors)


def predict_multinomial(model: PipelineModel, matrix: DataFrame, keys: list[str]) -> DataFrame:
    scored = model.transform(matrix.withColumn("features", array_to_vector(F.col("features"))))
    return scored.select(
        *keys,
        F.col("prediction").cast("int").alias("category"),
        F.array_max(vector_to_array("probability")).alias("prob"),
    )


def multinomial_gradient(model: PipelineModel, matrix: DataFrame, label: str) -> DataFrame:
    """Rows `(category, col_id, gradient)` of the regularised loss at the fitted coefficients.

    All are zero at the optimum. The sums combine in each task before their shuffle.
    """
    regression = model.stages[-1]
    weights = [[float(v) for v in row] for row in regression.coefficientMatrix.toArray()]
    penalty = F.array(*[F.array(*[F.lit(v) for v in row]) for row in weights])
    scored = model.transform(matrix.select(array_to_vector(F.col("features")).alias("features"), F.col(label).alias("_label"), F.col("features").alias("_x")))
    each = scored.select("_x", "_label", F.posexplode(vector_to_array("probability")).alias("category", "_p"))
    error = F.col("_p") - F.when(F.col("_label") == F.col("category"), 1.0).otherwise(0.0)
    cells = each.select("category", error.alias("_error"), F.posexplode("_x").alias("col_id", "_value"))
    means = cells.groupBy("category", "col_id").agg(F.avg(F.col("_error") * F.col("_value")).alias("_mean"))
    weight = F.get(F.get(penalty, F.col("category")), F.col("col_id"))
    return means.select("category", "col_id", (F.col("_mean") + F.lit(regression.getRegParam()) * weight).alias("gradient"))
