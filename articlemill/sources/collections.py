"""Collections of documents that are saved by id: a document that is saved again replaces itself.

A collection is Parquet in buckets by a hash of the id, one folder each. A save reads and writes the buckets of its own
documents only; the files of all others stay as they are. Spark writes the new buckets beside the old ones and puts them in place when the job ends, so a
job that fails changes nothing. Saves to one collection must follow each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
#: Folders are named by it and the number of buckets, so a reader knows how ids were dealt out.
BUCKET_COLUMN = "_bucket_of_"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def stored_buckets(spark: SparkSession, path: str) -> int | None:
    """How many buckets the collection at a path has; None if there is none."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    system = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not system.exists(folder):
        return None
    names = (status.getPath().getName() for status in system.listStatus(folder))
    found = next((n for n in names if n.startswith(BUCKET_COLUMN)), None)
    return int(found.removeprefix(BUCKET_COLUMN).split("=")[0]) if found else None


def bucketed(spark: SparkSession, path: str) -> DataFrame:
    # Buckets may differ in columns; the union of all is read.
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """All documents, in no order."""
    stored = bucketed(spark, path)
    return stored.drop(*[c for c in stored.columns if c.startswith(BUCKET_COLUMN)])


def read_by_ids(spark: SparkSession, path: str, id_column: str, ids: list) -> DataFrame:
    """The documents with these ids; only their buckets are read."""
    stored, buckets = bucketed(spark, path), stored_buckets(spark, path)
    keys = spark.createDataFrame([(i,) for i in ids], f"id {stored.schema[id_column].dataType.simpleString()}")
    touched = [r.b for r in keys.select(bucket_of(F.col("id"), buckets).alias("b")).distinct().collect()]
    name = f"{BUCKET_COLUMN}{buckets}"
    return stored.filter(F.col(name).isin(touched) & F.col(id_column).isin(list(ids))).drop(name)


def latest(df: DataFrame, id_column: str, order: str | None) -> DataFrame:
    """One row per id: the last by `order`, or by a hash of the row where there is none or it is equal."""
    tie = F.xxhash64(*[F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()])
    place = F.struct(*([F.col(order)] if order else []), tie.alias("_tie"))
    # An aggregate, so that many rows of one id combine before their shuffle.
    last = df.groupBy(id_column).agg(F.max_by(F.struct(*df.columns), place).alias("_last"))
    return last.select("_last.*")


def save_by_id(df: DataFrame, path: str, id_column: str = "_id", order: str | None = None, buckets: int = BUCKETS) -> list[int]:
    """Saves documents into the collection at `path`, which comes to be if there is none, and returns the buckets it wrote.

    Of several rows with one id in a save the last by `order` counts. Documents with a null id are refused. A collection keeps its
    number of buckets; choose it so that a bucket fits a few tasks. Saving the same rows again changes no document.
    Columns that one side lacks are null there.
    """
    spark = df.sparkSession
    there = stored_buckets(spark, path)
    buckets = there or buckets
    name = f"{BUCKET_COLUMN}{buckets}"
    wanted = df.withColumn(id_column, F.when(F.col(id_column).isNull(), F.raise_error(F.lit("a document without id cannot be saved")).cast(df.schema[id_column].dataType)).otherwise(F.col(id_column)))
    rows = latest(wanted, id_column, order).withColumn(name, bucket_of(F.col(id_column), buckets))
    touched = sorted(r[0] for r in df.select(bucket_of(F.col(id_column), buckets)).distinct().collect() if r[0] is not None)
    if there:
        # Only folders of these buckets are read.
        others = bucketed(spark, path).filter(F.col(name).isin(touched)).join(rows.select(name, id_column), [name, id_column], "left_anti")
        rows = others.unionByName(rows, allowMissingColumns=True)
    if touched or not there:
        writer = rows.repartition(name).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(name).parquet(path)
    return touched
