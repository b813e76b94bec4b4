"""Small frames with the odd cases that every operator has to bear."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "many plain words of one long text " * 4000


def rows(texts: dict[int | None, str | None]) -> list[tuple]:
    return [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts.items()]


def odd_documents(spark):
    """Nulls in every column, empty and blank texts, a very long one, equal rows, equal texts."""
    data = rows({1: None, 2: "", 3: " \n\t ", 4: LONG, 5: LONG, 6: "one", 7: "!!! ???", 8: "Ünïcödé 你好 \U0001f600 text"})
    data += [(None, "a text without a key, and of some words", None, None, None), (9, "an equal row of ten words or so, which is here twice", "en", "s", 1)]
    data += [(9, "an equal row of ten words or so, which is here twice", "en", "s", 1), (10, None, None, None, None)]
    return spark.createDataFrame(data, SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def words(seed: int, n: int, vocabulary: int = 2000) -> list[str]:
    draw = random.Random(seed)
    return [f"w{draw.randrange(vocabulary)}x" for _ in range(n)]


def documents(spark, texts: dict):
    return spark.createDataFrame(rows(texts), SCHEMA).repartition(3)


def by_key(df, key: str = "doc_id") -> dict:
    return {r[key]: r for r in df.collect()}
