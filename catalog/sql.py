"""Pieces of the comparison SQL."""

from __future__ import annotations

import glob
import os
import zipfile

import pyspark
from pyspark import SparkContext

from articlemill.functions.stopwords import SHORT_STOPWORDS, english_stopwords
from articlemill.functions.text import NON_SPACE, SENTENCE, WORD_OR_MARK

WORD_RX = WORD_OR_MARK
SPACE_RX = NON_SPACE
SENTENCE_RX = SENTENCE
ALPHA = "string_split_regex(lower(regexp_replace(text, '[^A-Za-z ]+', '', 'g')), ' +')"
ALNUM = "string_split_regex(lower(regexp_replace(text, '[^A-Za-z0-9 ]+', '', 'g')), ' +')"


def sql_list(words) -> str:
    quoted = ", ".join("'" + w.replace("'", "''") + "'" for w in words)
    return f"({quoted})"


def short_list() -> str:
    return sql_list(SHORT_STOPWORDS)


def english_list() -> str:
    """Spark's English stoplist; from the jar where no Spark runs in this process."""
    if SparkContext._active_spark_context is not None:
        return sql_list(english_stopwords())
    jar = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))[0]
    with zipfile.ZipFile(jar) as archive:
        text = archive.read("org/apache/spark/ml/feature/stopwords/english.txt").decode()
    return sql_list(w for w in text.splitlines() if w)


def token_rows(array: str, source: str = "documents", keys: str = "doc_id") -> str:
    """Rows `(keys, pos, token)` of an array expression."""
    return f"""SELECT {keys}, CAST(unnest(range(len(a))) AS INTEGER) AS pos, unnest(a) AS token
        FROM (SELECT {keys}, {array} AS a FROM {source}) AS arrays"""


def spans_sql(source: str, keys: list[str], text: str, pattern: str, position: str = "pos") -> str:
    k = ", ".join(keys)
    return f"""SELECT {k}, {position}, CAST(e - length(hit) AS INTEGER) AS begin,
        CAST(e AS INTEGER) AS "end", hit AS text FROM (
          SELECT {k}, {position}, hit,
            sum(length(gap) + length(hit)) OVER (PARTITION BY {k} ORDER BY {position}) AS e FROM (
              SELECT {k}, CAST(unnest(range(len(g))) AS INTEGER) AS {position},
                unnest(m) AS hit, unnest(g) AS gap FROM (
                  SELECT {k}, regexp_extract_all({text}, '{pattern}') AS m,
                    string_split_regex({text}, '{pattern}') AS g FROM {source}) AS s1) AS s2
          WHERE hit IS NOT NULL) AS s3"""


def pattern_spans_sql(source: str, keys: list[str], text: str, patterns: dict[str, str]) -> str:
    k = ", ".join(keys)
    parts = [
        f"""SELECT {k}, '{kind}' AS type, begin, "end", text
        FROM ({spans_sql(source, keys, text, pattern)}) AS p{i}"""
        for i, (kind, pattern) in enumerate(patterns.items())
    ]
    return " UNION ALL ".join(parts)
