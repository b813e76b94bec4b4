"""Documents in envelopes `(_id, kind, doc)`, and the views a document store offers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlemill.operators.lookup import keyed_join

MAX_INLINE_KEYS = 1000


def envelope(df: DataFrame, doc_id: Column, kind: str, doc: Column) -> DataFrame:
    return df.select(doc_id.alias("_id"), F.lit(kind).alias("kind"), doc.alias("doc"))


def all_docs(store: DataFrame) -> DataFrame:
    return store.select("_id", "doc.*")


def metadata(store: DataFrame) -> DataFrame:
    """Ids and kinds only; column pruning keeps the bodies out of the scan."""
    return store.select("_id", "kind")


def view_by_kind(store: DataFrame, kind: str) -> DataFrame:
    return store.filter(F.col("kind") == kind).select(
        F.col("_id").alias("key"), F.col("doc").alias("value")
    )


def key_value_view(df: DataFrame, doc_id: Column, key: Column, value: Column) -> DataFrame:
    """Rows in key order, and by id within a key, as a stored view serves them.

    The id also parts a key that many documents share over several ranges of the sort.
    """
    view = df.select(doc_id.alias("id"), key.alias("key"), value.alias("value"))
    return view.orderBy("key", "id")


def lookup_by_ids(df: DataFrame, id_column: str, keys: list | DataFrame) -> DataFrame:
    """Rows with the given ids: a pushed-down IN list, or a join for a table of keys."""
    if isinstance(keys, DataFrame):
        return keyed_join(df, keys.select(id_column).distinct(), [id_column], "left_semi")
    if len(keys) <= MAX_INLINE_KEYS:
        return df.filter(F.col(id_column).isin(list(keys)))
    field = df.schema[id_column]
    table = df.sparkSession.createDataFrame([(k,) for k in set(keys)], f"{id_column} {field.dataType.simpleString()}")
    return keyed_join(df, table, [id_column], "left_semi")


def rekey(df: DataFrame, id_column: str, prefix: str, fields: list[str]) -> DataFrame:
    """A copy of each document under a prefixed id, with only the named fields."""
    new_id = F.concat(F.lit(prefix), F.col(id_column).cast("string"))
    return df.select(new_id.alias("_id"), *fields)


def replace_collection(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_collection(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def inferred_schema(df: DataFrame, column: str) -> str:
    """The schema of stored JSON objects as DDL, from all rows: the union of their fields, with types that hold every value.

    One pass that sends a schema per task; `printSchema` shows it once applied. Null and broken texts do not count; with no object the schema is empty.
    """
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(column))).first()[0]
    return found.replace("OBJECT<", "STRUCT<") if found and found.startswith("OBJECT<") else "STRUCT<>"


def with_inferred_fields(df: DataFrame, column: str, name: str = "doc") -> DataFrame:
    """Adds the objects of a JSON column as structs of the schema that all of them fit; null where a text is no such object."""
    return df.withColumn(name, F.from_json(column, inferred_schema(df, column)))


def render_header(title: Column) -> Column:
    return F.concat(F.lit("<h1>"), title, F.lit("</h1>"))
