"""A stored view: rows in key order, of which a range of keys is read without the rest.

The rows are sorted into files by key, and a small table beside them has the least and the greatest key of each file. A
reader looks up the files that can hold its range and opens those alone. Rows are parted by key and by a
hash of the row, so a key that very many rows share takes several files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS, FILES = "rows", "files"


def write_view(df: DataFrame, path: str, key: str, files: int | None = None) -> None:
    """Writes the view; one that is there is replaced. `files` is the number of files, else that of the session's shuffles.

    Null keys come first, as in a document store. Equal keys are in the order of a hash of their rows, so a retry writes the same files.
    """
    hashed = F.xxhash64(*[F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()])
    order = [F.asc_nulls_first(key), F.col("_tie")]
    rows = df.withColumn("_tie", hashed)
    parted = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    parted.sortWithinPartitions(*order).drop("_tie").write.mode("overwrite").parquet(f"{path}/{ROWS}")
    written = df.sparkSession.read.schema(df.schema).parquet(f"{path}/{ROWS}")
    each = written.select(F.col("_metadata.file_path").alias("file"), F.col(key).alias("key"))
    ends = each.groupBy("file").agg(F.min("key").alias("least"), F.max("key").alias("most"), F.count(F.lit(1)).alias("n"), F.count("key").alias("n_keyed"))
    # A row per file.
    ends.coalesce(1).write.mode("overwrite").parquet(f"{path}/{FILES}")


def files_of_range(spark: SparkSession, path: str, start=None, end=None) -> list[str]:
    """The files that can hold keys from `start` to `end`, both included; with no start, null keys too."""
    files = spark.read.parquet(f"{path}/{FILES}")
    low = F.lit(True) if start is None else F.col("most") >= F.lit(start)
    high = F.lit(True) if end is None else (F.col("least") <= F.lit(end)) | (F.lit(start is None) & (F.col("n_keyed") < F.col("n")))
    return [r.file for r in files.filter(F.coalesce(low & high, F.lit(start is None))).orderBy("least", "file").select("file").collect()]


def read_range(spark: SparkSession, path: str, key: str, start=None, end=None, descending: bool = False, limit: int | None = None) -> DataFrame:
    """Rows with keys from `start` to `end`, both included, in key order; None leaves a side open, and with no start null keys come first.

    `limit` is a number of rows to serve. A range that no file can hold gives no rows.
    """
    schema = spark.read.parquet(f"{path}/{ROWS}").schema
    files = [f"{path}/{ROWS}"] if start is None and end is None else files_of_range(spark, path, start, end)
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    if start is not None:
        rows = rows.filter(F.col(key) >= F.lit(start))
    if end is not None:
        rows = rows.filter((F.col(key) <= F.lit(end)) | (F.lit(start is None) & F.col(key).isNull()))
    ordered = rows.orderBy(F.desc_nulls_last(key) if descending else F.asc_nulls_first(key))
    return ordered.limit(limit) if limit is not None else ordered
