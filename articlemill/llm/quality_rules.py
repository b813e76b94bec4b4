"""Quality rules: gradient-boosted trees over document statistics, with monotonic constraints.

The trees are grown on a bounded sample of labelled rows and flattened into arrays of
nodes, so a batch of documents is scored by array steps: no row is visited by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articlemill.llm.common import extended
from articlemill.llm.text_stats import FEATURES

#: Labelled rows that the trees are grown on, at most: those whose keys have the smallest hashes.
FIT_ROWS = 20_000
#: A larger value never makes a text better (-1) in the eyes of the rules.
MONOTONE = {
    "symbols_per_word": -1, "dup_line_share": -1, "repeat_word_share": -1, "digit_share": -1,
    "mark_share": -1, "exclamations_per_word": -1, "bars_per_word": -1, "upper_share": -1, "control_share": -1,
    "echoed_share": -1,
}


@dataclass(frozen=True)
class Forest:
    """All trees in one set of node arrays; a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row: every tree takes all rows one level down at a time."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -60, 60)))


def best_split(bins, g, h, n_bins, signs, low, high, least, decay):
    """`(gain, feature, bin, left value, right value)` of the best admissible split, or None.

    A split on a constrained feature must order the values of its sides by the sign.
    """
    best = None
    total_g, total_h = g.sum(), h.sum()
    for f in range(bins.shape[1]):
        gl = np.cumsum(np.bincount(bins[:, f], g, n_bins))[:-1]
        hl = np.cumsum(np.bincount(bins[:, f], h, n_bins))[:-1]
        nl = np.cumsum(np.bincount(bins[:, f], minlength=n_bins))[:-1]
        gr, hr, nr = total_g - gl, total_h - hl, len(g) - nl
        left, right = np.clip(-gl / (hl + decay), low, high), np.clip(-gr / (hr + decay), low, high)
        gain = -(gl * left + 0.5 * (hl + decay) * left**2) - (gr * right + 0.5 * (hr + decay) * right**2)
        gain[(nl < least) | (nr < least) | (signs[f] * (right - left) < 0)] = -np.inf
        b = int(np.argmax(gain))
        if np.isfinite(gain[b]) and (best is None or gain[b] > best[0] + 1e-12):
            best = (gain[b], f, b, left[b], right[b])
    if best is None:
        return None
    value = np.clip(-total_g / (total_h + decay), low, high)
    return best if best[0] > -(total_g * value + 0.5 * (total_h + decay) * value**2) + 1e-9 else None


def grow_forest(
    x: np.ndarray, y: np.ndarray, signs: np.ndarray, trees: int = 60, depth: int = 4,
    rate: float = 0.15, n_bins: int = 64, least: int = 10, decay: float = 1.0,
) -> Forest:
    """Boosts trees on the logistic loss. Labels of one kind, or no rows, give a constant."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    if len(y) and 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(column, np.linspace(0, 1, n_bins + 1)[1:-1])) for column in x.T]
        bins = np.stack([np.searchsorted(c, column) for c, column in zip(cuts, x.T, strict=True)], 1)
        margin = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)

            def grow(rows, level, low, high, value, g=g, h=h):
                at = len(nodes)
                nodes.append([0, np.inf, at, at, rate * value])
                split = best_split(bins[rows], g[rows], h[rows], n_bins, signs, low, high, least, decay) if level < depth else None
                if split is None:
                    margin[rows] += rate * value
                    return at
                _, f, b, left, right = split
                middle, side = (left + right) / 2, bins[rows, f] <= b
                bounds = ((low, high), (low, high)) if not signs[f] else ((low, middle), (middle, high)) if signs[f] > 0 else ((middle, high), (low, middle))
                nodes[at][:2] = [f, cuts[f][b] if b < len(cuts[f]) else np.inf]
                nodes[at][2] = grow(rows[side], level + 1, *bounds[0], left)
                nodes[at][3] = grow(rows[~side], level + 1, *bounds[1], right)
                return at

            roots.append(len(nodes))
            grow(np.arange(len(y)), 0, -np.inf, np.inf, -g.sum() / (h.sum() + decay))
    columns = list(zip(*nodes, strict=True)) if nodes else [[]] * 5
    kinds = [np.int64, float, np.int64, np.int64, float]
    return Forest(*[np.array(c, k) for c, k in zip(columns, kinds, strict=True)], np.array(roots, np.int64), depth, base)


def fit_rules(labelled: DataFrame, label: str = "quality", key: str = "doc_id", rows: int = FIT_ROWS) -> Forest:
    """Grows the rules on at most `rows` rows that have `stats` and a label.

    The sample takes the rows of the smallest key hashes, so it does not depend on the
    order or the placing of rows. Rows with a null label or null statistics are left out.
    """
    known = labelled.filter(F.col(label).isNotNull() & F.col("stats").isNotNull())
    order = [F.xxhash64(F.col(key)), F.col(key), F.xxhash64("stats")]
    sample = known.orderBy(*order).limit(rows).select("stats", F.col(label).cast("double").alias("y")).toArrow()
    x = np.array(sample.column("stats").to_pylist(), float).reshape(-1, len(FEATURES))
    signs = np.array([MONOTONE.get(name, 0) for name in FEATURES])
    return grow_forest(x, sample.column("y").to_numpy(), signs)


def with_probability(df: DataFrame, forest: Forest, name: str = "score") -> DataFrame:
    """Adds the probability of label 1 to rows with `stats`."""
    kept = [c for c in df.columns if c != name]
    df = df.select(*[f"`{c}`" for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(kept.index("stats")).to_pylist(), float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forest.probability(x))], [*kept, name])

    return df.mapInArrow(run, extended(df, f"`{name}` double"))


def base_failed() -> F.Column:
    """Too few words, or more than a fifth of them in repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
