"""Multinomial logistic regression by Newton's method.

Each step is one pass over the rows: tasks add up the loss, its gradient and its Hessian at the current coefficients, the
sums are added by their place (in a shuffle, if there are many), and the driver solves for the next coefficients. What crosses the
network is a vector of fixed size for each task. Meant for up to MOST_PARAMETERS coefficients in all; wider
matrices take `classify.train_multinomial`, which needs no Hessian.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articlemill.sources.tables import scan_splits

# Tasks carry this module along, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Coefficients of all classes, beyond which a Hessian would not fit a task.
MOST_PARAMETERS = 4000
#: Numbers of a sum that travel as one row.
CHUNK = 8192
#: Sums of all tasks up to which the driver adds them up itself.
DRIVER_BYTES = 64 << 20
#: A step is halved at most so often before it is taken for rounding.
HALVINGS = 20


@dataclass(frozen=True)
class MultinomialModel:
    """A row of `coefficients` for each class; the last column is the intercept. `gradient` is its largest entry at the end, `steps` how many were taken."""

    classes: list[int]
    coefficients: np.ndarray
    reg_param: float
    gradient: float
    steps: int

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return softmax(with_ones(x) @ self.coefficients.T)[0]


def with_ones(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, np.ones(len(x))])


def softmax(odds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities, and the logarithm of what they were divided by."""
    top = odds.max(axis=1, keepdims=True)
    each = np.exp(odds - top)
    total = each.sum(axis=1, keepdims=True)
    return each / total, (top + np.log(total))[:, 0]


def features_of(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def sums_of(x: np.ndarray, y: np.ndarray, coefficients: np.ndarray) -> np.ndarray:
    """Rows, loss, gradient and Hessian of some rows, one behind the other."""
    ones, k = with_ones(x), len(coefficients)
    odds = ones @ coefficients.T
    p, log_total = softmax(odds)
    loss = (log_total - odds[np.arange(len(y)), y]).sum()
    error = p.copy()
    error[np.arange(len(y)), y] -= 1
    width = ones.shape[1]
    hessian = np.empty((k, width, k, width))
    for a in range(k):
        for b in range(a + 1):
            block = (ones * (p[:, a] * ((a == b) - p[:, b]))[:, None]).T @ ones
            hessian[a, :, b, :] = block
            hessian[b, :, a, :] = block.T
    return np.concatenate([[len(y), loss], (error.T @ ones).ravel(), hessian.ravel()])


def total_sums(rows: DataFrame, width: int, classes: list[int], coefficients: np.ndarray) -> np.ndarray:
    """`sums_of` all rows. Each task sends its sums in chunks; a chunk's are added up as they come."""
    known = np.array(classes)
    parameters = coefficients.size
    size = 2 + parameters + parameters * parameters

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                x, label = features_of(batch.column(0), width), batch.column(1).to_numpy()
                total += sums_of(x, np.searchsorted(known, label), coefficients)
        for i in range(0, size if total[0] else 0, CHUNK):
            yield pa.RecordBatch.from_arrays([pa.array([i // CHUNK]), pa.array([total[i : i + CHUNK].tobytes()])], ["chunk", "sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(part)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["chunk", "sums"])

    schema = "chunk bigint, sums binary"
    parts = rows.mapInArrow(per_task, schema)
    splits = scan_splits(rows)
    if splits is None or splits * size * 8 > DRIVER_BYTES:
        parts = parts.repartition("chunk").mapInArrow(added, schema)
    total = np.zeros(size)
    for r in parts.collect():
        total[r.chunk * CHUNK : (r.chunk + 1) * CHUNK] += np.frombuffer(r.sums)
    return total


class Objective:
    """The mean log loss plus half of `reg_param` times the squared coefficients (not the intercepts) at one point."""

    def __init__(self, sums: np.ndarray, coefficients: np.ndarray, reg_param: float):
        n, size = sums[0], coefficients.size
        penalty = np.full(coefficients.shape, reg_param)
        penalty[:, -1] = 0
        self.loss = sums[1] / n + 0.5 * (penalty * coefficients**2).sum()
        self.gradient = sums[2 : 2 + size].reshape(coefficients.shape) / n + penalty * coefficients
        self.hessian = sums[2 + size :].reshape(size, size) / n + np.diag(penalty.ravel())
        # A shift of all intercepts changes nothing; holding their sum makes the solution one.
        at = np.arange(len(coefficients)) * coefficients.shape[1] + coefficients.shape[1] - 1
        self.hessian[np.ix_(at, at)] += 1.0
        self.shape, self.regular = coefficients.shape, reg_param > 0

    def step(self) -> np.ndarray:
        solve = np.linalg.solve if self.regular else lambda a, b: np.linalg.lstsq(a, b, rcond=None)[0]
        return solve(self.hessian, -self.gradient.ravel()).reshape(self.shape)


def fit_multinomial(
    matrix: DataFrame, label: str, features: str = "features", reg_param: float = 0.01, tolerance: float = 1e-7, max_steps: int = 50,
) -> MultinomialModel:
    """Fits rows `(features array<double>, label)`; those with a null label, or null or missing features, do not count.

    Stops once no entry of the gradient exceeds `tolerance`, or no part of a step lowers the loss any more. The rows are scanned
    once a step, so cache them if they are costly. With no rows the model has no classes.
    """
    rows = matrix.select(F.col(features).cast("array<double>").alias("x"), F.col(label).cast("bigint").alias("y"))
    rows = rows.filter("x IS NOT NULL AND y IS NOT NULL AND NOT exists(x, v -> v IS NULL OR isnan(v))")
    shape = rows.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if shape.least is None:
        return MultinomialModel([], np.zeros((0, 1)), reg_param, 0.0, 0)
    if shape.least != shape.most:
        raise ValueError(f"rows of {shape.least} to {shape.most} features")
    width = shape.most
    # Labels are a closed list.
    classes = sorted(r.y for r in rows.select("y").distinct().collect())
    if len(classes) * (width + 1) > MOST_PARAMETERS:
        raise ValueError(f"{len(classes)} classes of {width} features are too many for a Hessian; use train_multinomial")
    coefficients = np.zeros((len(classes), width + 1))
    now = Objective(total_sums(rows, width, classes, coefficients), coefficients, reg_param)
    for taken in range(max_steps):
        if np.abs(now.gradient).max() <= tolerance:
            return MultinomialModel(classes, coefficients, reg_param, float(np.abs(now.gradient).max()), taken)
        step = now.step()
        for halving in range(HALVINGS):
            moved = coefficients + step / 2**halving
            there = Objective(total_sums(rows, width, classes, moved), moved, reg_param)
            if there.loss <= now.loss:
                break
        else:
            break
        coefficients, now = moved, there
    return MultinomialModel(classes, coefficients, reg_param, float(np.abs(now.gradient).max()), taken + 1)


def with_probabilities(model: MultinomialModel, matrix: DataFrame, features: str = "features", name: str = "probabilities") -> DataFrame:
    """Adds the probability of each class, in the order of `model.classes`; null where features are null or of another number."""
    schema = T.StructType([*matrix.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))])
    place, width = matrix.columns.index(features), model.coefficients.shape[1] - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place).cast(pa.list_(pa.float64()))
            good = (column.value_lengths().fill_null(-1).to_numpy() == width) & bool(model.classes)
            p = model.probabilities(features_of(column.filter(pa.array(good)), width)) if good.any() else np.empty((0, len(model.classes)))
            scored = iter(p.tolist())
            lists = [next(scored) if g else None for g in good]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.float64()))], schema.names)

    return matrix.mapInArrow(run, schema)


def predictions(model: MultinomialModel, matrix: DataFrame, keys: list[str], features: str = "features") -> DataFrame:
    """Rows `(keys, category, prob)`: the likeliest class, of equal ones the first."""
    scored = with_probabilities(model, matrix.select(*keys, features), features, "_p").withColumn("prob", F.array_max("_p"))
    place = (F.array_position("_p", F.col("prob")) - 1).cast("int")
    category = F.get(F.lit(model.classes).cast("array<bigint>") if model.classes else F.array().cast("array<bigint>"), place)
    return scored.select(*keys, category.cast("int").alias("category"), "prob")


def loss_gradient(model: MultinomialModel, matrix: DataFrame, label: str, features: str = "features") -> DataFrame:
    """Rows `(category, col_id, gradient)` of the regularised loss at the model's coefficients, by grouped means: all 0 at the optimum."""
    scored = with_probabilities(model, matrix.select(F.col(label).alias("_label"), F.col(features).alias("_x")).filter("_label IS NOT NULL"), "_x", "_p")
    each = scored.select("_x", "_label", F.posexplode("_p").alias("_k", "_each"))
    category = F.get(F.lit(model.classes).cast("array<bigint>"), F.col("_k")).cast("int")
    error = F.col("_each") - F.when(F.col("_label") == category, 1.0).otherwise(0.0)
    cells = each.select("_k", category.alias("category"), error.alias("_error"), F.posexplode("_x").alias("col_id", "_value"))
    means = cells.groupBy("_k", "category", "col_id").agg(F.avg(F.col("_error") * F.col("_value")).alias("_mean"))
    penalty = F.array(*[F.array(*[F.lit(float(v)) for v in row[:-1]]) for row in model.coefficients])
    weight = F.get(F.get(penalty, F.col("_k")), F.col("col_id"))
    return means.select("category", "col_id", (F.col("_mean") + F.lit(model.reg_param) * weight).alias("gradient"))
