"""Article files: whole files, JSON lines, tolerant and strict decoding, writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articlemill.schemas import ARTICLE_FIELDS, ARTICLE_SCHEMA, CORRUPT_COLUMN, DEFAULT_LABEL


def read_article_files(spark: SparkSession, path: str) -> DataFrame:
    """One row `(path, value)` for each file, empty files left out."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), "value").filter(
        F.length("value") > 0
    )


def read_article_lines(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Articles stored as one JSON object per line."""
    lines = spark.read.text(path).filter(F.length("value") > 0)
    return decode_strict(lines) if strict else good_articles(decode_tolerant(lines))


def decode_tolerant(
    df: DataFrame, column: str = "value", schema: T.StructType = ARTICLE_SCHEMA
) -> DataFrame:
    """Adds the struct `article`, and `_corrupt` holding the text of each bad record."""
    wide = T.StructType(schema.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    # A generator stands between, so that a record is parsed once, not again in a filter pushed down.
    parsed = df.select("*", F.explode(F.array(F.from_json(column, wide, options))).alias("_parsed"))
    fields = [F.col(f"_parsed.{f.name}").alias(f.name) for f in schema.fields]
    # A missing text and JSON that is no object leave no record either.
    unread = F.when(F.col("_parsed").isNull(), F.coalesce(F.col(column), F.lit("")))
    bad = F.coalesce(F.col(f"_parsed.{CORRUPT_COLUMN}"), unread)
    return parsed.select(
        *df.columns, F.struct(*fields).alias("article"), bad.alias(CORRUPT_COLUMN)
    )


def good_articles(decoded: DataFrame, column: str = "value", rejects: Observation | None = None) -> DataFrame:
    """The decoded records. `rejects` gets `rejected` and `read`, counted as the rows pass."""
    if rejects is not None:
        bad = F.count(F.col(CORRUPT_COLUMN)).alias("rejected")
        decoded = decoded.observe(rejects, bad, F.count(F.lit(1)).alias("read"))
    kept = [c for c in decoded.columns if c not in (column, "article", CORRUPT_COLUMN)]
    return decoded.filter(F.col(CORRUPT_COLUMN).isNull()).select(*kept, "article.*")


def rejected_articles(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(CORRUPT_COLUMN).isNotNull()).drop("article")


def decode_strict(
    df: DataFrame, column: str = "value", schema: T.StructType = ARTICLE_SCHEMA
) -> DataFrame:
    """Any bad record fails the job."""
    kept = [c for c in df.columns if c != column]
    parsed = F.from_json(column, schema, {"mode": "FAILFAST"}).alias("article")
    return df.select(*kept, parsed).select(*kept, "article.*")


def article_record(label: Column | None = None, default_label: str = DEFAULT_LABEL) -> list[Column]:
    """The article columns, with a default label where none is given."""
    given = F.col("label") if label is None else label
    columns = [F.col(name) for name in ARTICLE_FIELDS if name != "label"]
    return columns + [F.coalesce(given, F.lit(default_label)).alias("label")]


def article_json(fields: list[str] | None = None) -> Column:
    return F.to_json(F.struct(*(fields or ARTICLE_FIELDS)))


def with_article_id(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """A file id that a retried task computes again alike, unlike a random UUID."""
    parts = [F.coalesce(F.col(name), F.lit("")) for name in (fields or ARTICLE_FIELDS)]
    return df.withColumn("article_id", F.sha2(F.to_json(F.struct(*parts)), 256))


def write_articles_json(
    df: DataFrame, path: str, mode: str = "overwrite", one_per_file: bool = False
) -> int:
    """JSON lines, or one article per file where a reader asks for it; returns the count.

    `overwrite` replaces the folder; the output committer keeps only the files of
    the task attempt that won, so a retry leaves no second copy. The count is observed
    on the rows as they are written, without a second pass.
    """
    progress = Observation()
    writer = df.observe(progress, F.count(F.lit(1)).alias("n")).write.mode(mode)
    if one_per_file:
        writer = writer.option("maxRecordsPerFile", 1)
    writer.json(path)
    return progress.get["n"]
