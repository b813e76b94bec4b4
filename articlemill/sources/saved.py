"""Results that several later steps share, saved so that none of them shuffles by document again."""

from __future__ import annotations

from pyspark.sql import DataFrame

BUCKETS = 64


def save_by_key(df: DataFrame, table: str, keys: list[str], path: str, buckets: int = BUCKETS) -> DataFrame:
    """Saves rows as a table in buckets by `keys`, one file each, and returns it as read back.

    Groupings, windows and joins on these keys then find their rows in place. A table of the name is replaced. The rows of a key are
    in one bucket; choose the number of buckets so that one fits a few tasks' memory.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)
