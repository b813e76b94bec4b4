"""What several operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text that a task turns into Python objects at a time.
PIECE_BYTES = 2 << 20
#: Bytes that Spark sends to a Python worker at a time, unless one row has more.
BATCH_BYTES = 8 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers find this package where the driver found it, and bounds what they are sent at a time."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that `spark.checkpoint.dir` names, else a fresh one for a local session."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured or current:
        return (configured or current).rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="articlemill-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/articlemill/{name}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme that Spark gives it, so that tasks that open files themselves reach the same file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(path).toString()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet to the shared folder, and read again.

    Cuts the lineage: a lost executor costs a read, not a recomputation. The folder is
    scratch space; whoever names it empties it.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discarded(df: DataFrame) -> None:
    """Removes the files of a table that `stored` made, once nothing reads it any more."""
    hadoop = df.sparkSession._jvm.org.apache.hadoop.fs
    for file in df.inputFiles():
        folder = hadoop.Path(file).getParent()
        system = folder.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf())
        system.delete(folder, True)
        return


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut so that each piece has about PIECE_BYTES of text, or one row."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        size = batch.column(batch.schema.get_field_index(column)).nbytes
        step = max(1, rows * PIECE_BYTES // max(size, PIECE_BYTES))
        for start in range(0, rows, step):
            yield batch.slice(start, step)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def bytes_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding them."""
    return batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()


def crc_part(key: Column | str, parts: int) -> Column:
    """crc32 of the key as text, modulo `parts`; of the empty text for a null key."""
    return F.crc32(F.coalesce(F.col(key) if isinstance(key, str) else key, F.lit("")).cast("binary")) % parts


def id_part(column: str, parts: int) -> Column:
    return crc_part(F.col(column).cast("string"), parts)


def extended(df: DataFrame, columns: str) -> StructType:
    """The schema of a table and further columns, given as DDL."""
    return StructType([*df.schema.fields, *StructType.fromDDL(columns).fields])
