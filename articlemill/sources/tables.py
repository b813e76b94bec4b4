"""Reading tables, and placing their rows on the cores of the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

UNKNOWN_SIZE = 1 << 62
#: Stored bytes of the documents in one part. Stored text is compressed, and its token rows take some fifty times as much; a task sorts those of a part in memory.
PART_BYTES = 8 << 20


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scan_bytes(df: DataFrame) -> int | None:
    """How many bytes the scanned files have; None if not known.

    Reads the sizes of the plan's leaves. Asking for the partitions of `df.rdd` instead
    would run the shuffles and broadcasts below it.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return None if any(size >= UNKNOWN_SIZE for size in sizes) else sum(sizes)


def scan_splits(df: DataFrame) -> int | None:
    """How many splits of the usual size the scanned files have; None if not known."""
    size = scan_bytes(df)
    return None if size is None else -(-size // df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes())


def scan_parts(df: DataFrame) -> int:
    """How many parts of PART_BYTES the scanned files have; 1 if not known."""
    return max(1, -(-(scan_bytes(df) or 0) // PART_BYTES))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash the rows of a scan with fewer splits than cores onto all cores, in the parts of `by_document`.

    A large table has many more splits than the cluster has cores and is returned
    as it is, so text work on it starts without a shuffle. The number of partitions
    is explicit, because AQE would merge them again for their small byte size.
    """
    splits, cores = scan_splits(df), df.sparkSession.sparkContext.defaultParallelism
    if splits is None or splits >= cores:
        return df
    return df.repartition(max(cores, scan_parts(df)), *keys)


def by_document(df: DataFrame, *keys: str) -> DataFrame:
    """Place whole documents by key *before* they are exploded into tokens.

    Windows and groupings on the same keys then find their partitioning in place:
    the compact text is shuffled once, and its many token rows never are. A part holds at
    most PART_BYTES of stored text, so that a task's memory does not grow with the table.
    """
    session = df.sparkSession
    splits, cores = scan_splits(df), session.sparkContext.defaultParallelism
    if splits is None:
        return df.repartition(*keys)
    if splits < cores:
        return df.repartition(max(cores, scan_parts(df)), *keys)
    configured = int(session.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(configured, splits, scan_parts(df)), *keys)
