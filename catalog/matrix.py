"""Matrix operations over the embeddings, and models that classify."""

from __future__ import annotations

from pyspark.sql import functions as F

from articlemill.functions.stopwords import english_stopwords
from articlemill.functions.text import raw_tokens, tokens
from articlemill.operators import classify as K
from articlemill.operators import counts as C
from articlemill.operators import matrix as M
from articlemill.operators import newton
from articlemill.sources.tables import read_table, spread
from catalog.sql import ALPHA, english_list, token_rows

WORDS = 1000
THRESHOLD = 0.62


def matrix(spark, sf):
    features = F.col("embedding").cast("array<double>").alias("features")
    return read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("row_id"), features)


def class_means(spark, sf):
    """A narrow right-hand side: one column per label, the mean of its rows."""
    rows = read_table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("k", "v"))
    means = rows.groupBy("k", "label").agg(F.sum(F.col("v").cast("double")).alias("v"))
    columns = F.array_sort(F.collect_list(F.struct("label", "v")))
    return means.groupBy(F.col("k").cast("bigint").alias("row_id")).agg(
        F.transform(columns, lambda c: c["v"]).alias("features")
    )


def matrix_shape(spark, sf):
    return M.shape(matrix(spark, sf))


def matrix_cell(spark, sf):
    return M.cell(matrix(spark, sf), 3, 5)


def matrix_row(spark, sf):
    return M.cells(M.get_rows(matrix(spark, sf), [3]))


def matrix_rows(spark, sf):
    return M.cells(M.get_rows(matrix(spark, sf), [0, 2, 4]))


def matrix_first_row(spark, sf):
    return M.cells(M.first_row(matrix(spark, sf)))


def matrix_cols(spark, sf):
    return M.get_cols(matrix(spark, sf), [0, 2])


def matrix_index(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return M.with_row_index(orders, "o_orderkey")


def matrix_transpose(spark, sf):
    blocks = M.transpose(matrix(spark, sf), block=128)
    values = F.posexplode("features").alias("i", "value")
    return blocks.select("row_id", "block_id", values).select(
        "row_id", (F.col("block_id") * 128 + F.col("i")).alias("col_id"), "value"
    )


def matrix_multiply(spark, sf):
    product = M.multiply(matrix(spark, sf), class_means(spark, sf))
    return product.withColumn("value", F.round("value", 4))


def documents(spark, sf):
    return spread(read_table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


def labels(spark, sf):
    return read_table(spark, sf, "labels")


def labelled_dictionary(spark, sf):
    good = labels(spark, sf).filter("quality = 1")
    return C.labelled_dictionary(
        documents(spark, sf), good, "doc_id", raw_tokens(F.col("text")), WORDS, english_stopwords()
    )


def dictionary_score(spark, sf):
    dictionary = labelled_dictionary(spark, sf)
    unlabelled = documents(spark, sf).join(labels(spark, sf), "doc_id", "left_anti")
    scores = C.dictionary_scores(
        unlabelled, ["doc_id"], raw_tokens(F.col("text")), dictionary, bound=WORDS
    )
    return scores.withColumn("score", F.round("score", 6))


def dictionary_score_full(spark, sf):
    """Scores against all words of the labelled documents, as too many to broadcast."""
    named = documents(spark, sf).join(labels(spark, sf), "doc_id", "left_semi")
    dictionary = C.word_counts(named, raw_tokens(F.col("text")))
    unlabelled = read_table(spark, sf, "documents").select("doc_id", "text").join(
        labels(spark, sf), "doc_id", "left_anti"
    )
    scores = C.dictionary_scores(
        unlabelled, ["doc_id"], raw_tokens(F.col("text")), dictionary, max_rows=1000
    )
    return scores.withColumn("score", F.round("score", 6))


def dictionary_classify(spark, sf):
    return K.classify_by_dictionary(
        documents(spark, sf), labels(spark, sf).filter("quality = 1"), "doc_id",
        raw_tokens(F.col("text")), WORDS, THRESHOLD,
    ).withColumn("score", F.round("score", 6))


def doccat_predict(spark, sf):
    """Categories of the documents without label, learnt from those with one."""
    words = tokens(F.col("text")).alias("tokens")
    category = F.col("toxic").cast("double").alias("category")
    named = documents(spark, sf).join(labels(spark, sf).select("doc_id", category), "doc_id")
    model = K.train_document_categoriser(named.select("category", words))
    rest = read_table(spark, sf, "documents").join(labels(spark, sf), "doc_id", "left_anti")
    found = K.predict_categories(model, rest.select("doc_id", words), ["doc_id"])
    return found.withColumn("prob", F.round("prob", 5))


def labelled_matrix(spark, sf):
    features = F.col("embedding").cast("array<double>").alias("features")
    return read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("row_id"), features, "label")


def multinomial_gradient(spark, sf):
    """What is left of the loss's gradient after the fit, which is nothing but rounding."""
    rows = labelled_matrix(spark, sf)
    found = newton.loss_gradient(newton.fit_multinomial(rows, "label"), rows, "label")
    return found.withColumn("gradient", F.round("gradient", 6) + 0.0)


def multinomial_predict(spark, sf):
    rows = labelled_matrix(spark, sf)
    found = newton.predictions(newton.fit_multinomial(rows, "label"), rows, ["row_id", "label"])
    return found.withColumn("prob", F.round("prob", 4))


QUERIES = {
    f.__name__: f
    for f in [
        matrix_shape, matrix_cell, matrix_row, matrix_rows, matrix_first_row, matrix_cols,
        matrix_index, matrix_transpose, matrix_multiply, labelled_dictionary, dictionary_score,
        dictionary_score_full,
        dictionary_classify, doccat_predict, multinomial_predict, multinomial_gradient,
    ]
}


def oracles() -> dict[str, str]:
    cells = """(SELECT vec_id AS row_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS col_id,
        CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings)"""
    alpha = token_rows(f"[t FOR t IN {ALPHA} IF t <> '']")
    good = "(SELECT doc_id FROM labels WHERE quality = 1)"

    def dictionary(stop):
        return f"""(SELECT token AS word, count(*) AS cnt FROM ({alpha}) AS a
            WHERE doc_id IN {good} {stop} GROUP BY token ORDER BY cnt DESC, word LIMIT {WORDS})"""

    def scores(known, named):
        return f"""SELECT d.doc_id, count(a.token) AS n_tokens, count(k.word) AS n_matched,
            round(coalesce(count(k.word) / nullif(count(a.token), 0), 0), 6) AS score
            FROM documents AS d LEFT JOIN ({alpha}) AS a USING (doc_id)
            LEFT JOIN {known} AS k ON a.token = k.word
            WHERE d.doc_id NOT IN {named} GROUP BY d.doc_id"""

    stop = f"AND token NOT IN {english_list()}"
    return {
        "matrix_shape": """SELECT count(*) AS n_rows, CAST(max(len(embedding)) AS INTEGER) AS n_cols
            FROM embeddings""",
        "matrix_cell": f"SELECT * FROM {cells} AS c WHERE row_id = 3 AND col_id = 5",
        "matrix_row": f"SELECT * FROM {cells} AS c WHERE row_id = 3",
        "matrix_rows": f"SELECT * FROM {cells} AS c WHERE row_id IN (0, 2, 4)",
        "matrix_first_row": f"SELECT * FROM {cells} AS c WHERE row_id = (SELECT min(vec_id) FROM embeddings)",
        "matrix_cols": """SELECT vec_id AS row_id, CAST(embedding[1] AS DOUBLE) AS col_0,
            CAST(embedding[3] AS DOUBLE) AS col_2 FROM embeddings""",
        "matrix_index": """SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id, o_orderkey,
            o_totalprice FROM orders""",
        "matrix_transpose": f"""SELECT CAST(col_id AS BIGINT) AS row_id, row_id AS col_id, value
            FROM {cells} AS c""",
        "matrix_multiply": f"""WITH m AS (SELECT c.col_id AS k, label, sum(value) AS v
              FROM {cells} AS c JOIN embeddings ON vec_id = row_id GROUP BY c.col_id, label),
            n AS (SELECT k, v, label,
              dense_rank() OVER (ORDER BY label) - 1 AS j FROM m)
            SELECT row_id, CAST(j AS INTEGER) AS col_id, round(sum(value * v), 4) AS value
            FROM {cells} AS c JOIN n ON c.col_id = n.k GROUP BY row_id, j""",
        "labelled_dictionary": f"SELECT * FROM {dictionary(stop)} AS k",
        "dictionary_score": scores(dictionary(stop), "(SELECT doc_id FROM labels)"),
        "dictionary_score_full": scores(
            f"""(SELECT DISTINCT token AS word FROM ({alpha}) AS v
              WHERE doc_id IN (SELECT doc_id FROM labels))""", "(SELECT doc_id FROM labels)"
        ),
        "dictionary_classify": f"""SELECT *, CASE WHEN score >= {THRESHOLD} THEN 'corruption'
            ELSE 'noncorruption' END AS label FROM ({scores(dictionary(''), good)}) AS s""",
        "multinomial_gradient": """SELECT CAST(category AS INTEGER) AS category,
            CAST(col_id AS INTEGER) AS col_id, CAST(0 AS DOUBLE) AS gradient
            FROM range((SELECT max(label) + 1 FROM embeddings)) AS c(category),
              range((SELECT max(len(embedding)) FROM embeddings)) AS f(col_id)""",
        "doccat_predict": f"""WITH a AS MATERIALIZED ({alpha}),
            cls AS (SELECT toxic AS c, ln(count(*) + 1) -
                ln((SELECT count(*) FROM labels JOIN documents USING (doc_id)) + 2) AS prior
              FROM labels JOIN documents USING (doc_id) GROUP BY toxic),
            wc AS (SELECT toxic AS c, token, count(*) AS n
              FROM a JOIN labels USING (doc_id) GROUP BY toxic, token),
            voc AS (SELECT DISTINCT token FROM wc),
            tot AS (SELECT c, sum(n) + (SELECT count(*) FROM voc) AS total FROM wc GROUP BY c),
            theta AS (SELECT tot.c, voc.token, ln(coalesce(wc.n, 0) + 1) - ln(total) AS lp
              FROM tot CROSS JOIN voc LEFT JOIN wc ON wc.c = tot.c AND wc.token = voc.token),
            ll AS (SELECT doc_id, theta.c, sum(lp) AS s FROM a JOIN theta USING (token)
              WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id, theta.c),
            raw AS (SELECT d.doc_id, cls.c, prior + coalesce(s, 0) AS score FROM documents AS d
              CROSS JOIN cls LEFT JOIN ll ON ll.doc_id = d.doc_id AND ll.c = cls.c
              WHERE d.doc_id NOT IN (SELECT doc_id FROM labels))
            SELECT doc_id, CAST(arg_max(c, score) AS INTEGER) AS category,
              round(1 / (1 + exp(min(score) - max(score))), 5) AS prob FROM raw GROUP BY doc_id""",
    }
