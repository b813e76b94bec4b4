"""A matrix as rows `(row_id, features array<double>)` with 0-based indexes."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Tasks carry this module along, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_BUCKET = 2_000_000
BROADCAST_CELLS = 200_000


def with_row_index(
    df: DataFrame, key: str, name: str = "row_id", rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Numbers the rows from 0 in the order of a unique numeric column, rows without key last.

    A table of fewer rows than a bucket takes is numbered as it is. Else quantiles of the key cut the rows into buckets of like size,
    more of them for a larger table; each bucket is numbered on its own, and the sizes of the buckets before
    it are added. No window runs over the whole table. The cuts are constants of the
    plan, so a task that runs again places its rows alike. Rows with a null key make a bucket of
    their own, in the order of a hash of the row.
    """
    numbered = df.withColumn("_number", F.coalesce(F.col(key).cast("double"), F.lit(float("nan"))))
    tie = F.xxhash64(*[F.col(c) for c in hashable_columns(df)])
    n_rows = numbered.agg(F.count(F.when(~F.isnan("_number"), 1))).head()[0]
    if n_rows < rows_per_bucket:
        within = Window.partitionBy(F.isnan("_number")).orderBy(key, tie)
        index = F.when(F.isnan("_number"), F.lit(n_rows)).otherwise(F.lit(0)) + F.row_number().over(within) - 1
        return numbered.select(index.cast("bigint").alias(name), *df.columns)
    # A bucketizer wants two buckets at least.
    edges = [float("-inf"), *(_cuts(numbered, n_rows // rows_per_bucket + 1) or [0.0]), float("inf")]
    bucketizer = Bucketizer(splits=edges, inputCol="_number", outputCol="_bucket", handleInvalid="keep")
    placed = bucketizer.transform(numbered)
    sizes = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_bucket").orderBy(key, tie)
    ranked = placed.withColumn("_within", F.row_number().over(within) - 1)
    # One row of offsets per bucket of millions of rows.
    joined = ranked.join(F.broadcast(offsets), "_bucket")
    index = (F.col("_offset") + F.col("_within")).alias(name)
    return joined.select(index, *df.columns)


def hashable_columns(df: DataFrame) -> list[str]:
    """Columns `xxhash64` accepts: all but those that hold a map or a variant."""
    return [
        f.name for f in df.schema.fields
        if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()
    ]


def _cuts(numbered: DataFrame, buckets: int) -> list[float]:
    """The cuts between so many buckets of like size."""
    number = F.when(~F.isnan("_number"), F.col("_number"))
    wanted = [i / buckets for i in range(1, buckets)]
    return sorted(set(numbered.agg(F.percentile_approx(number, wanted, 10 * buckets)).head()[0] or [])) if wanted else []


def shape(matrix: DataFrame) -> DataFrame:
    return matrix.agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.size("features")).alias("n_cols")
    )


def cell(matrix: DataFrame, row: int, col: int) -> DataFrame:
    value = F.get("features", F.lit(col)).alias("value")
    return matrix.filter(F.col("row_id") == row).select("row_id", F.lit(col).alias("col_id"), value)


def get_rows(matrix: DataFrame, rows: list[int]) -> DataFrame:
    return matrix.filter(F.col("row_id").isin(list(rows)))


def get_cols(matrix: DataFrame, cols: list[int]) -> DataFrame:
    """The chosen columns side by side, all in one pass over the rows."""
    return matrix.select("row_id", *[F.get("features", F.lit(c)).alias(f"col_{c}") for c in cols])


def first_row(matrix: DataFrame) -> DataFrame:
    return matrix.orderBy("row_id").limit(1)


def cells(matrix: DataFrame) -> DataFrame:
    """Coordinate form `(row_id, col_id, value)`."""
    return matrix.select("row_id", F.posexplode("features").alias("col_id", "value"))


def transpose_cells(matrix: DataFrame) -> DataFrame:
    """The transposed matrix in coordinate form, without a shuffle."""
    swapped = cells(matrix)
    return swapped.select(
        F.col("col_id").cast("bigint").alias("row_id"), F.col("row_id").alias("col_id"), "value"
    )


def transpose(matrix: DataFrame, block: int = 4096) -> DataFrame:
    """Rows `(row_id, block_id, features)` of the transposed matrix, in blocks.

    A column of a tall matrix does not fit one task, so each transposed row comes in
    pieces of `block` values; `block_id * block` is the index of a piece's first value.
    """
    turned = transpose_cells(matrix).withColumn("block_id", F.floor(F.col("col_id") / block))
    values = F.array_sort(F.collect_list(F.struct("col_id", "value")))
    return turned.groupBy("row_id", "block_id").agg(
        F.transform(values, lambda c: c["value"]).alias("features")
    )


def multiply(
    left: DataFrame, right: DataFrame, block: int = 1024, broadcast_cells: int = BROADCAST_CELLS
) -> DataFrame:
    """Cells `(row_id, col_id, value)` of the product; fails if the shapes do not fit.

    Both sides must be full matrices: rows 0 to n - 1, once each, of one length. A right side of
    at most `broadcast_cells` cells is sent to the tasks, which multiply whole batches of left
    rows: no shuffle. Otherwise dense blocks of both sides meet by their inner block; see
    `_block_products`.
    """
    inner, wide = _dimensions(right, "right")
    rows, width = _dimensions(left, "left")
    if width != inner:
        raise ValueError(f"cannot multiply: {width} columns with {inner} rows")
    if inner * wide <= broadcast_cells:
        listed = right.orderBy("row_id").select("features").collect()
        factor = np.array([r["features"] for r in listed], float).reshape(inner, wide)
        return left.select("row_id", "features").mapInArrow(_times(factor), CELLS)
    return _block_products(left, right, -(-rows // block), block)


CELLS = "row_id bigint, col_id int, value double"


def _dimensions(matrix: DataFrame, side: str) -> tuple[int, int]:
    size = F.size("features")
    # Numbers 0 to n - 1, once each, have this sum and this sum of hashes; no row number is shuffled to find out.
    hashes = F.sum(F.xxhash64(F.col("row_id").cast("bigint")).cast("decimal(38,0)"))
    n, keyed, low, high, short, long, total = matrix.agg(
        F.count(F.lit(1)), F.count("row_id"), F.min("row_id"), F.max("row_id"), F.min(size), F.max(size), hashes
    ).head()
    expected = matrix.sparkSession.range(n).select(F.col("id").alias("row_id")).agg(hashes).head()[0] if n else None
    if n and (keyed != n or low != 0 or high != n - 1 or short != long or total != expected):
        raise ValueError(f"cannot multiply: the {side} side lacks rows or its rows differ in length")
    return n, long or 0


def _cells_of(rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    """Cells of a dense piece with these row and column numbers."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(rows, len(columns)).astype(np.int64)),
            pa.array(np.tile(columns, len(rows)).astype(np.int32)),
            pa.array(values.ravel()),
        ],
        ["row_id", "col_id", "value"],
    )


def _times(factor: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = np.arange(factor.shape[1])
        for batch in batches:
            values = batch.column(1).flatten().fill_null(0.0).to_numpy(zero_copy_only=False)
            rows = values.reshape(batch.num_rows, factor.shape[0])
            yield _cells_of(batch.column(0).to_numpy(), columns, rows @ factor)

    return run


def _strips(matrix: DataFrame, block: int, first: str, second: str) -> DataFrame:
    """Dense blocks `(first, second, rows)`: rows grouped by `block`, each cut into pieces of `block` values."""
    pieces = F.sequence(F.lit(0), F.floor((F.size("features") - 1) / block).cast("int"))
    cut = matrix.select("row_id", "features", F.explode(pieces).alias(second))
    part = F.struct("row_id", F.slice("features", F.col(second) * block + 1, F.lit(block)).alias("part"))
    grouped = cut.groupBy(F.floor(F.col("row_id") / block).cast("int").alias(first), second)
    return grouped.agg(F.sort_array(F.collect_list(part)).alias("rows"))


def _block_products(left: DataFrame, right: DataFrame, row_blocks: int, block: int) -> DataFrame:
    """Products of the left blocks `(ib, kb)` with the right blocks `(kb, jb)`, summed over kb.

    The few inner blocks are the join's keys, so left blocks are spread over `splits` more keys and
    right blocks copied to them: as many as there are left row blocks, up to the tasks of a shuffle.
    """
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    splits = max(1, min(row_blocks, tasks))
    a = _strips(left, block, "ib", "kb").withColumn("split", F.col("ib") % splits)
    copies = F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("split")
    b = _strips(right, block, "kb", "jb").select("kb", "jb", F.col("rows").alias("factor"), copies)
    met = a.join(b, ["kb", "split"]).select("rows", "jb", "factor")

    def dense(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        values = rows.field("part")
        return rows.field("row_id").to_numpy(), values.flatten().fill_null(0.0).to_numpy(zero_copy_only=False).reshape(len(rows), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                numbers, values = dense(batch.column(0)[i].values)
                _, factor = dense(batch.column(2)[i].values)
                columns = batch.column(1)[i].as_py() * block + np.arange(factor.shape[1])
                yield _cells_of(numbers, columns, values @ factor)

    products = met.mapInArrow(run, CELLS)
    return products.groupBy("row_id", "col_id").agg(F.sum("value").alias("value"))
