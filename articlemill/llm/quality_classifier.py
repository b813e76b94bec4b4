"""Quality classifier: kernel ridge regression on random Fourier features, calibrated.

Random Fourier features turn a Gaussian kernel over standardised document statistics
into inner products of a fixed length. The normal equations of the ridge fit are sums
over rows, so tasks send sums of that fixed size, whatever the number of rows. Isotonic
regression over the fit's scores of other rows makes them probabilities; it is fitted to
sums per bin, so it also covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articlemill.llm.common import bytes_of, extended, id_part, pieces
from articlemill.llm.text_stats import FEATURES, measured

WIDTH = 256  #: random features
SCALE = 3.0  #: of the kernel, in standard deviations
RIDGE = 1e-5  #: per row
BINS = 2000  #: of scores, for the calibration
SLOTS = 32  #: rows that reach the driver, at most


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    levels: np.ndarray  #: calibrated score of each bin

    def raw(self, x: np.ndarray) -> np.ndarray:
        return random_features((x - self.mean) / self.spread) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.round(np.interp(self.raw(x), bin_middles(), self.levels), 6)


def random_features(z: np.ndarray) -> np.ndarray:
    """Cosines of fixed random projections, and a constant.

    Far values are squashed first, so that an outlier keeps neighbours on its side of the kernel.
    """
    draw = np.random.default_rng(20_240_229)
    directions = draw.standard_normal((len(FEATURES), WIDTH)) / SCALE
    shifts = draw.uniform(0, 2 * np.pi, WIDTH)
    waves = np.cos(np.clip(np.arcsinh(2 * z) / 2, -8, 8) @ directions + shifts) * np.sqrt(2 / WIDTH)
    return np.hstack([waves, np.ones((len(z), 1))])


def bin_middles() -> np.ndarray:
    """Raw scores lie near 0 to 1; the bins reach from -0.5 to 1.5, and the end ones take the rest."""
    return (np.arange(BINS) + 0.5) / BINS * 2 - 0.5


def bin_of(raw: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((raw + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int64)


def rows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x = np.array(batch.column(0).to_pylist(), float).reshape(-1, len(FEATURES))
    return x, batch.column(1).to_numpy(zero_copy_only=False)


def summed(df: DataFrame, of_rows, length: int) -> np.ndarray:
    """The sum over all rows of `of_rows(x, y)`, an array of `length` numbers.

    Each task sends one array, tasks of a second step add those of a slot as they stream
    in, and the driver adds the few slots.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            if batch.num_rows:
                total += of_rows(*rows_of(batch))
        if total.any():
            slot = TaskContext.get().partitionId() % SLOTS
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([total.tobytes()])], ["slot", "sums"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            for sums in batch.column(1).to_pylist():
                total += np.frombuffer(sums)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()])], ["slot", "sums"])

    schema = "slot int, sums binary"
    merged = df.mapInArrow(part, schema).repartitionById(SLOTS, "slot").mapInArrow(merge, schema)
    return sum((np.frombuffer(row.sums) for row in merged.collect()), np.zeros(length))


def isotonic(total: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Pool-adjacent-violators over bins: ascending shares of good rows, carried into empty bins."""
    blocks: list[list[float]] = []  # rows, good rows, last bin
    for b in np.flatnonzero(total):
        blocks.append([total[b], good[b], b])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n, k, end = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n, blocks[-1][1] + k, end]
    if not blocks:
        return np.linspace(0, 1, len(total))
    level, start = np.zeros(len(total)), 0
    for n, k, end in blocks:
        level[start : int(end) + 1] = (k + 0.01) / (n + 0.02)
        start = int(end) + 1
    level[start:] = level[start - 1]
    return np.maximum.accumulate(level)


def fit(labelled: DataFrame, label: str = "quality", key: str = "doc_id") -> Model:
    """Fits rows that have `stats` and a label: four fifths of the keys the ridge, the rest the calibration.

    Rows with a null label or null statistics are left out; without rows every score is 0.5.
    """
    known = labelled.filter(F.col(label).isNotNull() & F.col("stats").isNotNull())
    rows = known.select("stats", F.col(label).cast("double").alias("y"), (id_part(key, 5) == 4).alias("calibrates"))
    d, w = len(FEATURES), WIDTH + 1

    def moments(x, y):
        return np.concatenate([[len(y)], x.sum(0), (x * x).sum(0)])

    total = summed(rows, moments, 1 + 2 * d)
    if not total[0]:
        return Model(np.zeros(d), np.ones(d), np.zeros(w), np.full(BINS, 0.5))
    mean = total[1 : d + 1] / total[0]
    spread = np.sqrt(np.maximum(total[d + 1 :] / total[0] - mean**2, 0))
    spread[spread < 1e-9] = 1

    def equations(x, y):
        z = random_features((x - mean) / spread)
        return np.concatenate([[len(y)], (z.T @ z).ravel(), z.T @ y])

    sums = summed(rows.filter(~F.col("calibrates")), equations, 1 + w * w + w)
    n, left, right = max(sums[0], 1), sums[1 : 1 + w * w].reshape(w, w), sums[1 + w * w :]
    model = Model(mean, spread, np.linalg.solve(left + RIDGE * n * np.eye(w), right), np.empty(0))

    def histogram(x, y):
        at = bin_of(model.raw(x))
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, BINS)])

    counted = summed(rows.filter("calibrates"), histogram, 2 * BINS)
    return Model(mean, spread, model.weights, isotonic(counted[:BINS], counted[BINS:]))


def with_score(df: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Adds the calibrated score to rows with `stats`."""
    kept = [c for c in df.columns if c != name]
    df = df.select(*[f"`{c}`" for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(kept.index("stats")).to_pylist(), float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x))], [*kept, name])

    return df.mapInArrow(run, extended(df, f"`{name}` double"))


def accepted(df: DataFrame, model: Model, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows whose text scores `least` or more, all their columns as they are. One scan."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            keep = model.score(measured(bytes_of(piece, text))[1]) >= least
            yield piece.filter(pa.array(keep)).rename_columns(names)

    return df.mapInArrow(run, df.schema)
