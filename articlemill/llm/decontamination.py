"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A window is a run of item words: `width` of them, or the whole item if it has fewer. A
document holds a window if it holds all its words, in place. As every word of a window must be
there, one word is a prefix that no match can lack: the rarest, by the number
of documents that hold it. Windows are keyed by it, with its place in them.

Documents send the places of words that may be keys, each with the words around it that a window could reach. These meet the keys by word; the
key's place in its window fixes where the window would begin, and begin and length must lie within the document. The words that stand there are then
compared with whole windows in a join on these words, so a frequent key meets only windows that are there.

Tables of any size meet in joins. Tasks are sent only a filter of fixed size that most words fail which no window needs, or the
needed words themselves if they are few.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articlemill.llm.common import bytes_of, extended, pieces, stored
from articlemill.llm.plain_words import plain_words

WIDTH = 10
#: Words up to which they are sent to the tasks; of more a filter is.
SET_WORDS = 200_000
#: Blocks of 64 bits in a filter of words, at most: 8 MB.
FILTER_BLOCKS = 1 << 20
#: Words of which a task remembers whether they pass the filter.
MEMO = 200_000
#: Texts with hits, and hits, up to which they are broadcast to the documents; beyond, documents are joined by shuffle.
BROADCAST_ROWS, BROADCAST_HITS = 200_000, 2_000_000
#: Rows that a task sends at a time.
OUT_ROWS = 10_000


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """`(window, item)`: the distinct windows, words parted by blanks, of each item.

    Ids are strings; that of a null key is empty. Items without words have no windows.
    """
    rows = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            for item, t in zip(piece.column(0).to_pylist(), bytes_of(piece), strict=True):
                words = plain_words(t)
                windows = {b" ".join(words[i : i + width]).decode() for i in range(max(1, len(words) - width + 1))} if words else set()
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(windows), pa.string()), pa.array(sorted(windows), pa.string())], ["item", "window"])

    return rows.mapInArrow(cut, "item string, window string").select("window", "item").distinct()


def place_in_filter(word: bytes, blocks: int) -> tuple[int, int]:
    """A block, and four bits there."""
    x = xxhash.xxh3_64_intdigest(word)
    return (x >> 24) % blocks, (1 << (x & 63)) | (1 << (x >> 6 & 63)) | (1 << (x >> 12 & 63)) | (1 << (x >> 18 & 63))


def word_filter(words: DataFrame) -> np.ndarray:
    """A filter that all of the distinct words pass, and few others unless they are very many."""
    blocks = max(1, min(FILTER_BLOCKS, words.count() // 4))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [place_in_filter(w, blocks) for w in bytes_of(batch, "word")]
            bits = np.array([b for _, b in found], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int64()), pa.array(bits)], ["block", "bits"])

    table = words.mapInArrow(run, "block bigint, bits bigint").groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(blocks, np.int64)
    bits[table.column("block").to_numpy()] = table.column("bits").to_numpy()
    return bits


class Passing(dict):
    """The words that pass a filter, used like a set; verdicts are remembered up to a bound."""

    def __init__(self, bits: np.ndarray):
        super().__init__()
        self.bits = bits.view(np.uint64)

    def __contains__(self, word: bytes) -> bool:
        return self[word]

    def isdisjoint(self, words: list[bytes]) -> bool:
        return not any(map(self.__getitem__, words))

    def intersection(self, words: list[bytes]) -> set[bytes]:
        return {w for w in set(words) if self[w]}

    def __missing__(self, word: bytes) -> bool:
        block, mask = place_in_filter(word, len(self.bits))
        passes = int(self.bits[block]) & mask == mask
        if len(self) < MEMO:
            self[word] = passes
        return passes


def sent_words(words: DataFrame) -> frozenset[bytes] | np.ndarray:
    """What tasks are sent of the distinct words: few of them as they are, else a filter."""
    if words.limit(SET_WORDS + 1).count() > SET_WORDS:
        return word_filter(words)
    return frozenset(bytes_of(words.toArrow(), "word"))


def received(sent: frozenset[bytes] | np.ndarray) -> frozenset[bytes] | Passing:
    return sent if isinstance(sent, frozenset) else Passing(sent)


def document_frequency(docs: DataFrame, words: DataFrame, text: str = "text") -> DataFrame:
    """`(word, n)`: in how many documents each of the distinct words occurs. Tasks add up what they read."""
    sent = docs.sparkSession.sparkContext.broadcast(sent_words(words))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = Counter(), received(sent.value)
        for piece in pieces(batches):
            for t in bytes_of(piece):
                total.update(known.intersection(plain_words(t)))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in total], pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return words.join(counted, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))


def keyed_windows(windows: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """`(word, offset, length, window)`: the distinct windows, each with its rarest word and that word's first place in it."""
    words = windows.select("window").distinct().select("window", F.posexplode(F.split("window", " ")).alias("offset", "word"))
    frequency = document_frequency(docs, words.select("word").distinct(), text)
    rarest = words.join(frequency, "word").groupBy("window").agg(F.min(F.struct("n", "word", "offset")).alias("key"), F.count(F.lit(1)).cast("int").alias("length"))
    return rarest.select("key.word", "key.offset", "length", "window")


def key_places(docs: DataFrame, keyed: DataFrame, text: str, width: int) -> DataFrame:
    """`(digest, at, start, word, around)` of each place of a word that may be a key: the digest of the text, and the words from `start` on that a window with it can reach."""
    sent = docs.sparkSession.sparkContext.broadcast(sent_words(keyed.select("word").distinct()))
    names = ["digest", "at", "start", "word", "around"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rows = received(sent.value), []
        for piece in pieces(batches):
            for t in bytes_of(piece):
                words = plain_words(t)
                places = [] if known.isdisjoint(words) else [at for at, w in enumerate(words) if w in known]
                digest = hashlib.md5(t).hexdigest() if places else ""
                for at in places:
                    start = max(0, at - width + 1)
                    rows.append((digest, at, start, words[at].decode(), b" ".join(words[start : at + width]).decode()))
                    if len(rows) == OUT_ROWS:
                        yield batch(rows)
                        rows = []
        if rows:
            yield batch(rows)

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "digest string, at bigint, start bigint, word string, around string")


def window_hits(docs: DataFrame, keyed: DataFrame, text: str, width: int) -> DataFrame:
    """`(digest, begin, end, window)`: the distinct occurrences of windows in texts."""
    places = keyed.select("word", "offset", "length").distinct()
    met = key_places(docs, keyed, text, width).join(places, "word")
    words, begin = F.split("around", " "), F.col("at") - F.col("offset")
    within = (begin >= F.col("start")) & (begin + F.col("length") <= F.col("start") + F.size(words))
    first = F.greatest(begin - F.col("start") + 1, F.lit(1)).cast("int")  # Spark may cut before it filters
    standing = F.array_join(F.slice(words, first, F.col("length")), " ")
    candidates = met.filter(within).select("digest", begin.alias("begin"), (begin + F.col("length")).alias("end"), standing.alias("window"))
    return candidates.join(keyed.select("window"), "window", "left_semi").select("digest", "begin", "end", "window").distinct()


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans joined where they overlap or touch, in order."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


FOUND = "n_words bigint, hits array<struct<begin: bigint, end: bigint>>, items array<string>"


def find_contamination(
    docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", width: int = WIDTH,
) -> DataFrame:
    """All columns of the documents with `n_words`, `hits` and `items`.

    `hits` are spans of words (from 0, end exclusive) inside occurrences of windows, joined
    and ordered; `items` are the sorted ids, as strings, of items with occurring windows. A null
    text has no words; a benchmark without words hits nothing. Equal texts share what is found in one of them, by their digest. Repeated rows and repeated items are
    fine; columns of these names are replaced.
    """
    windows = stored(item_windows(items, item_key, item_text, width), "windows")
    keyed = stored(keyed_windows(windows, docs, text), "keyed")
    hits = stored(window_hits(docs, keyed, text, width), "hits")
    # A text's own hits are at most as many as its words.
    spans = hits.groupBy("digest").agg(F.collect_set(F.struct("begin", "end")).alias("hits"))
    held = hits.select("digest", "window").distinct().join(windows, "window").groupBy("digest").agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = stored(spans.join(held, "digest"), "found")
    rows, places = found.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("hits") + F.size("items")), F.lit(0))).first()
    side = F.broadcast(found) if rows <= BROADCAST_ROWS and places <= BROADCAST_HITS else found
    kept = [c for c in docs.columns if c not in ("n_words", "hits", "items")]
    plain = docs.select(*[f"`{c}`" for c in kept])
    digest = F.md5(plain[text].cast("binary"))
    joined = plain.join(side, digest == side["digest"], "left").select(*[plain[c] for c in kept], side["hits"], side["items"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        for piece in pieces(batches, text):
            *own, found_hits, found_items = piece.columns
            counts = [len(plain_words(t)) for t in bytes_of(piece, text)]
            joined_hits = [[{"begin": b, "end": e} for b, e in merged([(h["begin"], h["end"]) for h in hits or ()])] for hits in found_hits.to_pylist()]
            columns = [pa.array(counts, pa.int64()), pa.array(joined_hits, span), pa.array([i or [] for i in found_items.to_pylist()], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*own, *columns], [*kept, "n_words", "hits", "items"])

    return joined.mapInArrow(run, extended(plain, FOUND))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """`(key, n_words, n_hit, n_items, items_sha256, contaminated)` of found contamination."""
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda total, h: total + h["end"] - h["begin"])
    return found.select(
        key, "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents in which no window occurs, with their columns as they were."""
    taken = {"n_words", "hits", "items"} & set(docs.columns)
    if taken:
        names = docs.columns
        moved = docs.toDF(*[f"_own_{i}" for i in range(len(names))])
        found = find_contamination(moved, items, f"_own_{names.index(text)}", **options)
        return found.filter(F.size("hits") == 0).select(*[F.col(f"_own_{i}").alias(c) for i, c in enumerate(names)])
    return find_contamination(docs, items, text, **options).filter(F.size("hits") == 0).select(*[f"`{c}`" for c in docs.columns])
