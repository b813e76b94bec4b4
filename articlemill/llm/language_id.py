"""Language identification by error-correcting output codes over hashed byte 3-grams.

Each language has a codeword of bits. A binary classifier per bit tells the languages
that have the bit from those that have not: its weights are log-ratios of the two
groups' mean 3-gram shares. Decoding adds the logistic losses of all bits against
each codeword and takes the language of the least loss.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articlemill.llm.common import extended, pieces, texts_of

BUCKETS = 1 << 15
SMOOTHING = 0.5
STEEP = 6.0  #: of the logistic loss, per unit of mean log-ratio
UNKNOWN = "und"
#: Letters, and numerals that are no decimal digits, which are none.
MAYBE_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(found[0].isalpha() for found in MAYBE_LETTER.finditer(text))


def gram_buckets(text: str) -> np.ndarray:
    """The bucket of every 3-gram of the lower-cased text's bytes; all but letters count as blanks."""
    b = np.frombuffer(f" {text.lower()} ".encode(), np.uint8)
    plain = (b < 97) | ((b > 122) & (b < 128))
    b = np.where(plain, 32, b).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.int64)
    grams = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    grams = grams[grams & 0xFFFF != 0x2020]  # of a run of blanks only the first counts
    return ((grams * np.uint32(2_654_435_761)) >> np.uint32(17)).astype(np.int64)


def code_words(n: int) -> np.ndarray:
    """A matrix of -1 and 1, a row per language: all splits for few languages, else random ones.

    Random codes have 10 log2(n) bits. Among several draws of a fixed seed the one whose
    nearest rows differ most is taken.
    """
    if n < 2:
        return np.ones((n, 1))
    if n <= 7:
        bits = [[1, *(1 if split >> k & 1 else -1 for k in range(n - 1))] for split in range(2 ** (n - 1) - 1)]
        return np.array(bits).T
    draw, best, least = np.random.default_rng(7), None, -1
    length = int(np.ceil(10 * np.log2(n)))
    for _ in range(50):
        words = draw.choice([-1, 1], (n, length))
        words = words[:, np.abs(words.sum(0)) < n]
        near = ((words.shape[1] - words @ words.T) / 2 + np.eye(n) * length).min()
        if near > least:
            best, least = words, near
    return best


@dataclass(frozen=True)
class Model:
    languages: list[str]
    words: np.ndarray  #: languages x bits
    weights: np.ndarray  #: buckets x bits

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Loss of each codeword for rows of bit margins: near 0 a bit weighs little, far off much."""
        return np.logaddexp(0, -STEEP * margins[:, None, :] * self.words[None]).sum(2)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """`(language, score, ambiguous)` of each text."""
        named = np.array([bool(self.languages) and t is not None and has_letter(t) for t in texts], bool)
        found, scores, open_ = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        if not named.any():
            return found, scores, open_
        margins = np.zeros((len(texts), self.words.shape[1]))
        for i in np.flatnonzero(named):
            at = gram_buckets(texts[i])
            if len(at):
                margins[i] = np.bincount(at, minlength=BUCKETS) @ self.weights / len(at) if len(at) > 2000 else self.weights[at].mean(0)
        loss = self.losses(margins)
        share = np.exp(-(loss - loss.min(1, keepdims=True)))
        share /= share.sum(1, keepdims=True)
        ordered = np.sort(share, 1)
        second = ordered[:, -2] if share.shape[1] > 1 else np.zeros(len(texts))
        best = np.argmin(loss, 1)
        for i in np.flatnonzero(named):
            found[i], scores[i] = self.languages[best[i]], round(float(ordered[i, -1]), 6)
        return found, scores, ~named | (ordered[:, -1] - second < 0.2)


def fit(df: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learns from all rows that have a text and a language.

    Each task adds up the 3-gram counts of its languages; what is shuffled and collected is
    bounded by languages x buckets. No rows give a model that knows no language.
    """
    rows = df.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for piece in pieces(batches):
            for t, language in zip(texts_of(piece), piece.column(1).to_pylist(), strict=True):
                if language not in sums:
                    sums[language] = np.zeros(BUCKETS, np.int64)
                sums[language] += np.bincount(gram_buckets(t), minlength=BUCKETS)
        for language, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([language] * len(at), pa.string()), pa.array(at), pa.array(counts[at])], ["lang", "bucket", "n"])

    counts = rows.mapInArrow(count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counts.toArrow()
    languages = sorted(set(table.column("lang").to_pylist()))
    if not languages:
        return Model([], np.zeros((0, 1)), np.zeros((BUCKETS, 1)))
    shares = np.full((len(languages), BUCKETS), SMOOTHING)
    place = {language: i for i, language in enumerate(languages)}
    shares[[place[x] for x in table.column("lang").to_pylist()], table.column("bucket").to_numpy()] += table.column("n").to_numpy()
    shares /= shares.sum(1, keepdims=True)
    words = code_words(len(languages))
    weights = np.zeros((BUCKETS, words.shape[1]))
    for bit in range(words.shape[1]):
        has = words[:, bit] > 0
        if 0 < has.sum() < len(has):
            weights[:, bit] = np.log(shares[has].mean(0)) - np.log(shares[~has].mean(0))
    return Model(languages, words, weights)


def with_language(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The columns but `text`, with `lang_pred`, `score` (share of the best codeword) and `ambiguous`.

    A text that is null or has no letter is `und` with score 0. Columns of these names are replaced.
    """
    kept = [c for c in df.columns if c not in (text, "lang_pred", "score", "ambiguous")]
    rows = df.select(*[f"`{c}`" for c in kept], f"`{text}`")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            found, scores, ambiguous = model.predict(texts_of(piece, text))
            columns = [*piece.columns[:-1], pa.array(found, pa.string()), pa.array(scores), pa.array(ambiguous)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "lang_pred", "score", "ambiguous"])

    return rows.mapInArrow(run, extended(rows.drop(text), "lang_pred string, score double, ambiguous boolean"))
