"""Statistics of whole texts, taken from their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from articlemill.llm.common import bytes_of, extended, pieces

SPACE = b"\t\n\v\f\r "
SYMBOLS = b"#*$%&|<>"
WINDOW = 5

#: Names of the exact counts of a text, in the order of `counts_of`.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Names of the statistics of a text, in the order of `statistics`.
FEATURES = [
    "log_words", "word_length", "symbols_per_word", "dup_line_share", "repeat_word_share",
    "upper_share", "digit_share", "mark_share", "exclamations_per_word", "stops_per_word",
    "commas_per_word", "bars_per_word", "words_per_line", "log_lines", "distinct_word_share",
    "wide_share", "control_share", "letter_entropy", "echoed_share",
]


def byte_set(values) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(values)] = True
    return mask


IS_SPACE, IS_SYMBOL, IS_UPPER = byte_set(SPACE), byte_set(SYMBOLS), byte_set(range(65, 91))
IS_LOWER, IS_DIGIT, IS_TAIL = byte_set(range(97, 123)), byte_set(range(48, 58)), byte_set(range(0x80, 0xC0))
IS_MARK = byte_set([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
IS_CONTROL, IS_HEAD = byte_set([*range(9), *range(14, 32), 127]), byte_set(range(0xC0, 0x100))


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words that stand in a window of five words which the text has twice or more."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    if distinct < 6000:  # its fifth power fits in 63 bits
        codes = ids[:n].copy()
        for k in range(1, WINDOW):
            codes *= distinct
            codes += ids[k : n + k]
    else:
        _, pair = np.unique(ids[:-1] * distinct + ids[1:], return_inverse=True)
        _, four = np.unique(pair[:-2] * len(pair) + pair[2:], return_inverse=True)
        codes = four[:n] * distinct + ids[WINDOW - 1 :]
    ordered = np.sort(codes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(codes, twice))
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(change)[:-1]))


def counts_of(text: bytes, histogram: np.ndarray) -> tuple[list[int], int, int, int]:
    """The exact counts; the lines that hold a word, the distinct words, the words equal to the one before."""
    words = text.split()
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    lines = [line for line in text.split(b"\n") if line.strip()]
    characters = int(histogram.sum() - histogram[IS_TAIL].sum())
    counts = [
        len(words),
        characters - int(histogram[IS_SPACE].sum()),
        int(histogram[IS_SYMBOL].sum()),
        len(lines) - len(set(lines)),
        repeated_words(ids, len(known)),
    ]
    return counts, len(lines), len(known), int(np.count_nonzero(ids[1:] == ids[:-1]))


def measure(text: bytes | None) -> tuple[list[int], list[float]]:
    """`(counts, statistics)` of a text; a null text counts as empty, whose statistics are zeros."""
    text = text or b""
    histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    counts, n_lines, n_distinct, n_echoed = counts_of(text, histogram)
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words = counts
    words, lines, chars = max(n_words, 1), max(n_lines, 1), max(word_chars, 1)
    upper, lower = histogram[IS_UPPER].sum(), histogram[IS_LOWER].sum()
    letters = histogram[65:91] + histogram[97:123]
    p = letters[letters > 0] / max(letters.sum(), 1)
    return counts, [
        np.log1p(n_words), word_chars / words, n_symbols / words, n_dup_lines / lines,
        n_repeat_words / words, upper / max(upper + lower, 1), histogram[IS_DIGIT].sum() / chars,
        histogram[IS_MARK].sum() / chars, histogram[33] / words, (histogram[46] + histogram[63]) / words,
        histogram[44] / words, histogram[124] / words, n_words / lines, np.log1p(n_lines), n_distinct / words,
        histogram[IS_HEAD].sum() / chars, histogram[IS_CONTROL].sum() / chars, float(-(p * np.log(p)).sum()),
        n_echoed / words,
    ]


def measured(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Counts and statistics of several texts, a row each."""
    both = [measure(t) for t in texts]
    counts = np.array([c for c, _ in both], np.int64).reshape(-1, len(COUNTS))
    return counts, np.array([s for _, s in both], float).reshape(-1, len(FEATURES))


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """The columns but `text`, with the exact counts and `stats` (array of double). One scan, no shuffle.

    Columns of `df` with these names are replaced.
    """
    kept = [c for c in df.columns if c != text and c not in COUNTS and c != "stats"]
    rows = df.select(*[f"`{c}`" for c in kept], f"`{text}`")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            counts, stats = measured(bytes_of(piece, text))
            columns = [*piece.columns[:-1], *map(pa.array, counts.T), pa.array(list(stats), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *COUNTS, "stats"])

    added = ", ".join(f"{name} bigint" for name in COUNTS) + ", stats array<double>"
    return rows.mapInArrow(run, extended(rows.drop(text), added))
