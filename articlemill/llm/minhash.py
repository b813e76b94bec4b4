"""MinHash near-duplicates with sequential Bayesian verification.

1. A scan makes each text's set of word shingles, its fingerprint and the keys of its
   MinHash bands. Texts of equal sets are one class; only its least document goes on.
2. Documents that share a band key are candidates of each other. They are gathered by
   star edges to the least document of the key, whose components hold all candidates.
3. Components are compared in blocks of bounded size against blocks. A pair's signatures
   are compared batch by batch: it is dropped as soon as the posterior probability
   that its similarity reaches the threshold falls below the chosen miss probability.
4. Pairs that are left are verified on their full sets. A block sends a spanning forest of
   its links, never all pairs, and the components of these links are the result.

The bands find a pair of similarity s with probability 1 - (1 - s^ROWS)^BANDS: at 0.8 all but
3 in 10 million.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from articlemill.llm.common import bytes_of, pieces, stored
from articlemill.llm.components import components

WORDS = 5
PERCENT = 80
BANDS, ROWS = 64, 7
#: Hashes compared at a time, and in all, one byte of each.
BATCH, COMPARED = 32, 256
#: Chosen probability that a pair at the threshold is dropped by one comparison of batches.
MISS = 1e-6
#: Documents of a component in a block.
BLOCK = 512
#: Candidates up to which their ids are broadcast to pick their texts; beyond, texts are joined by shuffle.
BROADCAST_ROWS = 2_000_000
#: Words whose hashes a task remembers.
MEMO = 200_000
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class WordHashes(dict):
    """Words to 64-bit hashes, up to a bound of remembered words."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < MEMO:
            self[word] = value
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, words: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `words` words; of the whole text if it has fewer."""
    found = text.translate(LOWER).split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    width = min(words, len(found))
    runs = np.full(len(found) - width + 1, width, np.uint64)
    for k in range(width):
        runs = mix(runs * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(found) - width + 1 + k])
    return np.unique(runs)


@functools.lru_cache(maxsize=1)
def families() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    draw = np.random.default_rng(424_242)
    n = BANDS * ROWS
    odd = draw.integers(0, 1 << 31, n, np.uint32) * np.uint32(2) + np.uint32(1)
    return odd, draw.integers(0, 1 << 32, n, np.uint32), draw.integers(0, 1 << 63, ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def signature(sets: np.ndarray) -> np.ndarray:
    """The least value of the set under each hash function."""
    factors, shifts, _ = families()
    low = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    x = (sets >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(x), 512):
        part = x[start : start + 512, None] * factors
        part += shifts
        np.minimum(low, part.min(0), out=low)
    return low


def band_keys(sign: np.ndarray) -> np.ndarray:
    rows = sign.reshape(BANDS, ROWS).astype(np.uint64) + np.uint64(1)
    return mix((mix(rows) * families()[2]).sum(1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def short_signature(sign: np.ndarray) -> bytes:
    return ((sign[:COMPARED] * np.uint32(2_654_435_761)) >> np.uint32(24)).astype(np.uint8).tobytes()


def sketches(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """`(doc, n_shingles, f1, f2, bands)` of every row; no fingerprint and no bands for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for piece in pieces(batches):
            sizes, prints, bands = [], [], []
            for t in bytes_of(piece):
                found = shingles(t, words, known)
                sizes.append(len(found))
                prints.append(np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64) if len(found) else (None, None))
                bands.append(band_keys(signature(found)) if len(found) else None)
            first, second = zip(*prints, strict=True)
            columns = [piece.column(0), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(bands, pa.list_(pa.int64()))], ["doc", "n_shingles", "f1", "f2", "bands"])

    rows = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc bigint, n_shingles bigint, f1 bigint, f2 bigint, bands array<bigint>")


def candidate_groups(sketched: DataFrame) -> DataFrame:
    """`(doc, grp)`: class representatives with a candidate, by the component of candidates."""
    known = sketched.filter("n_shingles > 0 AND doc IS NOT NULL")
    least = known.groupBy("f1", "f2").agg(F.min(F.struct("doc", "bands")).alias("least"))
    keys = least.select(F.col("least.doc").alias("doc"), F.explode("least.bands").alias("band"))
    hubs = keys.groupBy("band").agg(F.min("doc").alias("hub"), F.max("doc").alias("last")).filter("hub < last")
    edges = keys.join(hubs.select("band", "hub"), "band").select(F.col("doc").alias("a"), F.col("hub").alias("b"))
    return components(edges).select(F.col("node").alias("doc"), F.col("component").alias("grp"))


@functools.lru_cache(maxsize=8)
def least_matches(percent: int) -> dict[int, int]:
    """For each number of compared hashes the least matches with which a pair goes on.

    With a uniform prior the similarity's posterior after k matches of n is Beta(k + 1,
    n - k + 1); the probability that it reaches t is that of at most k successes in n + 1 trials of t.
    A byte of a hash also matches by chance, once in 256 times, which only lets pairs go on.
    """
    t, out = percent / 100, {}
    for n in range(BATCH, COMPARED + 1, BATCH):
        total, k = 0.0, -1
        while k < n and total < MISS:
            k += 1
            total += comb(n + 1, k) * t**k * (1 - t) ** (n + 1 - k)
        out[n] = k
    return out


def surviving_pairs(signs: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of left x right whose signatures pass every batch; pruned pairs see no further batch.

    Of a block and itself each pair is taken once.
    """
    needed = least_matches(percent)
    a, b, matches = None, None, None
    for n in range(BATCH, COMPARED + 1, BATCH):
        at = slice(n - BATCH, n)
        if a is None:
            counts = np.stack([(signs[i, at] == signs[right, at]).sum(1, dtype=np.int32) for i in left])
            x, y = np.nonzero(counts >= needed[n])
            a, b, matches = left[x], right[y], counts[x, y]
            if left is right:
                once = a < b
                a, b, matches = a[once], b[once], matches[once]
        else:
            matches = matches + np.concatenate([
                (signs[a[s : s + 65_536], at] == signs[b[s : s + 65_536], at]).sum(1, dtype=np.int32) for s in range(0, len(a), 65_536)
            ])
            on = matches >= needed[n]
            a, b, matches = a[on], b[on], matches[on]
        if not len(a):
            break
    return a, b


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of all intersections: products of the incidence of shingles that two sets have."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count >= 2
    column = np.cumsum(shared) - 1
    on = shared[at]
    owner, at, width = owner[on], column[at[on]], int(shared.sum())
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, width, 4096):
        some = slice(*np.searchsorted(at, [start, start + 4096]))
        incidence = np.zeros((len(sets), min(4096, width - start)), np.float32)
        incidence[owner[some], at[some] - start] = 1
        total += incidence @ incidence.T
    return total


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Of links between n nodes those that join two trees."""
    root, kept = list(range(n)), []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        x, y = top(i), top(j)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append((i, j))
    return kept


def block_links(table: pa.Table, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the verified links between the two blocks of a table (or within the one)."""
    # Rows of one key may have several texts; equal rows are taken once.
    rows = zip(table.column("doc").to_pylist(), table.column("sign").to_pylist(), strict=True)
    table = table.take(pa.array(sorted({row: i for i, row in enumerate(rows)}.values()), pa.int64()))
    docs = table.column("doc").to_numpy()
    signs = np.frombuffer(b"".join(table.column("sign").to_pylist()), np.uint8).reshape(len(docs), COMPARED)
    block, low, high = (table.column(c).to_numpy() for c in ("block", "low", "high"))
    left = np.flatnonzero(block == low)
    right = left if low[0] == high[0] else np.flatnonzero(block == high)
    a, b = surviving_pairs(signs, left, right, percent)
    if not len(a):
        return []
    involved, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    binary = table.column("shingles")
    sets = [np.frombuffer(binary[int(i)].as_py(), np.uint64) for i in involved]
    both = shared_counts(sets)
    x, y = at[: len(a)], at[len(a) :]
    size = np.array([len(s) for s in sets], float)
    shared = both[x, y].astype(float)
    linked = 100 * shared >= percent * (size[x] + size[y] - shared)
    return [(int(docs[involved[i]]), int(docs[involved[j]])) for i, j in forest(len(involved), x[linked], y[linked])]


def links(docs: DataFrame, groups: DataFrame, key: str, text: str, words: int, percent: int) -> DataFrame:
    """`(a, b)`: links that join the documents of each group of candidates as all its links would."""
    sizes = groups.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    wanted = stored(groups.join(sizes, "grp"), "candidates")
    rows = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text"))
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for piece in pieces(batches):
            found = [shingles(t, words, known) for t in bytes_of(piece)]
            columns = [piece.column(0), pa.array([short_signature(signature(s)) for s in found]), pa.array([s.tobytes() for s in found])]
            yield pa.RecordBatch.from_arrays([*columns, piece.column(2), piece.column(3)], ["doc", "sign", "shingles", "grp", "blocks"])

    picked = rows.join(side, "doc").select("doc", "text", "grp", "blocks").filter("text IS NOT NULL")
    made = picked.mapInArrow(prepare, "doc bigint, sign binary, shingles binary, grp bigint, blocks int")
    block = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    placed = made.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("doc", "sign", "shingles", "grp", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))

    def compare(table: pa.Table) -> pa.Table:
        found = block_links(table, percent)
        return pa.table({"a": pa.array([i for i, _ in found], pa.int64()), "b": pa.array([j for _, j in found], pa.int64())})

    return placed.groupBy("grp", "low", "high").applyInArrow(compare, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """`(key, n_shingles, component_id, kept)` of every row.

    Documents are linked if 100 * shared >= percent * joint shingles; a component's id is its least
    key, whose document is kept. A null or blank text has no shingles and is kept, linked
    with nothing; so is a row with a null key (its component is null). Rows of one key are one document.
    """
    sketched = stored(sketches(docs, key, text, words), "sketches")
    known = sketched.filter("n_shingles > 0 AND doc IS NOT NULL")
    # Stored, so that the join has two shuffled sides and a class of very many copies can be split.
    classes = stored(known.groupBy("f1", "f2").agg(F.min("doc").alias("node")), "classes")
    rows = sketched.select("doc", "n_shingles", "f1", "f2").join(classes, ["f1", "f2"], "left")
    rows = stored(rows.select("doc", "n_shingles", "node"), "nodes")
    # Keys with several texts tie the classes of these together.
    several = rows.groupBy("doc").agg(F.min("node").alias("b"), F.max("node").alias("last")).filter("b < last")
    ties = rows.join(several.select("doc", "b"), "doc").filter("node <> b").select(F.col("node").alias("a"), "b")
    found = components(links(docs, candidate_groups(sketched), key, text, words, percent).union(ties))
    placed = rows.join(found, "node", "left")
    component = F.when(F.col("doc").isNotNull(), F.coalesce("component", "node", "doc"))
    kept = F.coalesce(F.col("doc") == component, F.lit(True))
    return placed.select(F.col("doc").alias(key), "n_shingles", component.alias("component_id"), kept.alias("kept"))


def without_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The documents that are kept, one row each, with their columns as they were.

    Which go is a small table next to the texts: up to a bound it is broadcast, so texts are not
    shuffled. Only keys that occur more than once have their rows gathered; the first of them
    by the hash of its text stays. A row with a null key stays.
    """
    decided = stored(near_duplicates(docs, key, text, words, percent), "decided").select(F.col(key).alias("_decided"), "kept")
    gone = decided.filter(~F.col("kept")).select("_decided").distinct()
    twice = stored(decided.filter("_decided IS NOT NULL").groupBy("_decided").count().filter("count > 1").select("_decided"), "twice")

    def listed(ids: DataFrame, how: str, rows: DataFrame) -> DataFrame:
        side = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
        return rows.join(side, rows[key] == side["_decided"], how)

    kept = listed(gone, "left_anti", docs)
    if twice.isEmpty():
        return kept
    first = W.partitionBy(f"`{key}`").orderBy(F.xxhash64(F.col(text)))
    place = max(docs.columns, key=len) + "_place"  # a name that no column has
    once = listed(twice, "left_semi", kept).withColumn(place, F.row_number().over(first)).filter(F.col(f"`{place}`") == 1).drop(place)
    return listed(twice, "left_anti", kept).unionByName(once)
