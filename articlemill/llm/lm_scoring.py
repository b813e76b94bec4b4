"""LM scoring by cross-entropy difference.

Two bigram models, of the target texts and of all texts (the background), share order,
smoothing and vocabulary: every word that the target has twice; any other word is the unknown word.
With c the counts of a model, N its tokens, V the vocabulary,

    P(w | h) = B c(h, w) / c(h) + (1 - B) (c(w) + 1) / (N + V).

A token's loss difference is log P_background - log P_target: negative where the target
model expects it more. A document's score is the mean over its tokens, less is closer to the target.

All counts are taken over all texts, and every word and every pair counts, however rare. Nothing that grows with the texts goes to the driver or to
every task. Texts are read once, into blocks of documents whose words are numbered within the block. A block then asks for
what it needs and no more: the totals of its own words, and, once it knows which of them are unknown, the totals of its own pairs. What it asks for are sorted
hashes with the block's counts, cut into buckets by hash; a bucket adds up what all blocks sent it and answers each block in the order it
asked, so an answer needs no keys. A question and its answer are a row for each block and bucket, packed to a few bytes for each word or pair.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articlemill.llm.common import bytes_of, discarded, pieces, stored
from articlemill.llm.minhash import LOWER

#: Share of the target's tokens that a word needs, besides two occurrences, to be in the vocabulary.
WORD_SHARE = 0.0
#: Times that a model must have met a pair to count it.
LEAST = 1
#: Tokens from which on a block is closed.
BLOCK_TOKENS = 1 << 21
#: Words or pairs that all blocks together ask a bucket for, about.
BUCKET_KEYS = 1 << 20
BIGRAM_WEIGHT = 0.6
#: Hashes of the unknown word and of the start of a text.
UNKNOWN, START = 0, 1


def packed(values: np.ndarray, ascending: bool = False) -> bytes:
    """Numbers from 0 on, as planes of bytes without the empty ones, compressed; of ascending numbers the steps."""
    numbers = values.astype(np.uint64)
    if ascending:
        numbers = np.diff(numbers, prepend=np.uint64(0))
    width = (int(numbers.max(initial=0)).bit_length() + 7) // 8
    planes = numbers.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + len(numbers).to_bytes(8, "little") + zlib.compress(planes.tobytes(), 1)


def unpacked(data: bytes, ascending: bool = False) -> np.ndarray:
    width, count = data[0], int.from_bytes(data[1:9], "little")
    planes = np.zeros((count, 8), np.uint8)
    if width:
        planes[:, :width] = np.frombuffer(zlib.decompress(data[9:]), np.uint8).reshape(width, count).T
    numbers = planes.reshape(-1).view(np.uint64)
    return np.cumsum(numbers, dtype=np.uint64) if ascending else numbers


def several(arrays: list[np.ndarray]) -> bytes:
    return packed(np.concatenate(arrays))


def parted(data: bytes, count: int) -> list[np.ndarray]:
    return [a.astype(np.int64) for a in np.split(unpacked(data), count)]


def word_hash(word: bytes) -> int:
    return max(int.from_bytes(blake2b(word, digest_size=8).digest(), "little"), START + 1)


def mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of two hashes."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(factor) + second
    return x ^ (x >> np.uint64(29))


class Block:
    """Documents with their tokens as numbers of words, and the words' hashes in ascending order."""

    def __init__(self, sizes: np.ndarray, flags: np.ndarray, tokens: np.ndarray, hashes: np.ndarray):
        self.sizes, self.flags, self.tokens, self.hashes = sizes.astype(np.int64), flags.astype(bool), tokens.astype(np.int64), hashes
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.chosen = self.flags[self.owner]

    def counted(self, numbers: np.ndarray, size: int) -> list[np.ndarray]:
        """How often each number stands at the tokens, in all documents and in the target's."""
        return [np.bincount(some, minlength=size) for some in (numbers, numbers[self.chosen])]

    def word_counts(self) -> list[np.ndarray]:
        """Of each word, as a word and as a history, in all documents and in the target's."""
        size, solid = len(self.hashes), self.sizes > 0
        last = self.tokens[np.cumsum(self.sizes)[solid] - 1]
        ends = [np.bincount(some, minlength=size) for some in (last, last[self.flags[solid]])]
        words = self.counted(self.tokens, size)
        return [*words, words[0] - ends[0], words[1] - ends[1]]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each pair, in the order of its hash: history, word, hash; then the pair's number at each token. The start is the number after the last word."""
        base = len(self.hashes) + 1
        before = np.roll(self.tokens, 1)
        before[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = base - 1
        codes, at = np.unique(before * base + self.tokens, return_inverse=True)
        history, word = codes // base, codes % base
        both = np.append(self.hashes, np.uint64(START))
        keys = mixed(both[history], both[word])
        order = np.argsort(keys, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        return history[order], word[order], keys[order], place[at]


def blocks_of(docs: DataFrame, key: str, text: str, is_target: str) -> DataFrame:
    """A row for each block. Only its first columns are read for the sums over all blocks."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(F.col(is_target), F.lit(False)).alias("flag"))
    sums = "block bigint, n bigint, n_target bigint, starts bigint, starts_target bigint, n_words bigint"
    schema = T.StructType([*T.StructType.fromDDL(sums).fields, T.StructField("keys", T.ArrayType(rows.schema["key"].dataType)),
                           *T.StructType.fromDDL("sizes binary, flags binary, tokens binary, words binary, totals binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        keys: list[pa.Array] = []
        numbers: dict[bytes, int] = {}
        tokens: list[np.ndarray] = []
        flags: list[bool] = []

        def block() -> pa.RecordBatch:
            hashes = np.fromiter(map(word_hash, numbers), np.uint64, len(numbers))
            order = np.argsort(hashes, kind="stable")
            place = np.empty_like(order)
            place[order] = np.arange(len(order))
            sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
            marked = np.array(flags, bool)
            whole = place[np.concatenate([*tokens, np.empty(0, np.int32)])] if len(order) else np.empty(0, np.int64)
            own = pa.concat_arrays(keys)
            columns = [(task << 24) + made, sizes.sum(), sizes[marked].sum(), (sizes > 0).sum(), (sizes[marked] > 0).sum(), len(order)]
            blobs = [packed(sizes), packed(marked), packed(whole), packed(hashes[order], True), None]
            return pa.RecordBatch.from_arrays(
                [*[pa.array([int(c)], pa.int64()) for c in columns], pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own), *[pa.array([b], pa.binary()) for b in blobs]],
                [f.name for f in schema],
            )

        held = 0
        for piece in pieces(batches):
            keys.append(piece.column(0))
            flags += piece.column(2).to_pylist()
            for t in bytes_of(piece):
                words = t.translate(LOWER).split() if t else []
                tokens.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words)))
                held += len(words)
            if held >= BLOCK_TOKENS:
                yield block()
                keys, tokens, flags, held, made = [], [], [], 0, made + 1
                numbers.clear()
        if keys:
            yield block()

    return rows.mapInArrow(run, schema)


def read_block(row: dict) -> Block:
    return Block(unpacked(row["sizes"]), unpacked(row["flags"]), unpacked(row["tokens"]), unpacked(row["words"], True))


QUESTION = "bucket bigint, block bigint, keys binary, counts binary"
#: Besides the answer, once for each bucket: how many words are known, and the counts of all others.
ANSWER = "bucket bigint, block bigint, answer binary, known bigint, n bigint, n_target bigint, h bigint, h_target bigint"


def asked(blocks: DataFrame, buckets: int, what: Callable[[Block], tuple[np.ndarray, list[np.ndarray]]]) -> DataFrame:
    """The questions of each block: ascending hashes and the counts beside them, by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = what(read_block(row))
                bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                edges = np.flatnonzero(np.diff(bucket)) + 1
                for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)], strict=True):
                    if b > a:
                        parts = [pa.array([int(bucket[a])], pa.int64()), pa.array([row["block"]], pa.int64()), pa.array([packed(keys[a:b], True)]), pa.array([several([c[a:b] for c in counts])])]
                        yield pa.RecordBatch.from_arrays(parts, ["bucket", "block", "keys", "counts"])

    return blocks.select("block", "sizes", "flags", "tokens", "words").mapInArrow(run, QUESTION)


def answered(questions: DataFrame, counts: int, floor: float | None = None) -> DataFrame:
    """The totals of what each block asked for. With a `floor`, words with fewer occurrences in the target are summed as unknown."""
    def answers(rows: list[tuple[int, bytes, bytes]], bucket: int) -> Iterator[pa.RecordBatch]:
        keys = [unpacked(k, True) for _, k, _ in rows]
        ends = np.cumsum([len(k) for k in keys])
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        each = [parted(c, counts) for *_, c in rows]
        totals = [np.bincount(at, np.concatenate([e[i] for e in each]), len(distinct)).astype(np.int64) for i in range(counts)]
        summary: list = [None] * 5
        if floor is not None:
            known = totals[1] >= floor
            summary = [int(known.sum()), *[int(t[~known].sum()) for t in totals]]
        for i, (block, *_) in enumerate(rows):
            some = at[ends[i] - len(keys[i]) : ends[i]]
            row = [bucket, block, several([t[some] for t in totals]), *(summary if i == 0 else [None] * 5)]
            kinds = [pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    names = [part.split()[0] for part in ANSWER.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now = None
        for batch in batches:
            for bucket, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if bucket != now and held:
                    yield from answers(held, now)
                    held = []
                now = bucket
                held.append(tuple(row))
        if held:
            yield from answers(held, now)

    return questions.repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(run, ANSWER)


def with_answers(blocks: DataFrame, answers: DataFrame, counts: int, made: Callable[[dict, list[np.ndarray]], pa.RecordBatch], schema: T.StructType | str) -> DataFrame:
    """What `made` makes of each block and the totals that it asked for, in the order of its hashes."""
    rows = blocks.withColumn("bucket", F.lit(-1).cast("bigint")).withColumn("answer", F.lit(None).cast("binary"))
    both = rows.unionByName(answers.select("bucket", "block", "answer"), allowMissingColumns=True)
    placed = both.repartition("block").sortWithinPartitions("block", "bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, found = None, []

        def finished() -> Iterator[pa.RecordBatch]:
            if block is not None:
                # Answers come a bucket at a time, each with all its counts.
                yield made(block, [np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(counts)])

        for batch in batches:
            place = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for i, bucket in enumerate(place["bucket"].to_pylist()):
                if bucket == -1:
                    yield from finished()
                    block = {name: column[i].as_py() for name, column in place.items() if name not in ("keys", "answer")}
                    block["keys"], found = place["keys"].slice(i, 1).flatten(), []
                else:
                    found.append(parted(place["answer"][i].as_py(), counts))
        yield from finished()

    return placed.mapInArrow(run, schema)


def with_known_words(blocks: DataFrame, answers: DataFrame, floor: float) -> DataFrame:
    """Blocks whose unknown words are one word, number 0, with the totals of the others."""
    schema = blocks.schema

    def made(row: dict, totals: list[np.ndarray]) -> pa.RecordBatch:
        known = totals[1] >= floor
        place = np.where(known, np.cumsum(known), 0)
        tokens = place[unpacked(row["tokens"]).astype(np.int64)] if len(known) else np.empty(0, np.int64)
        hashes = np.append(np.uint64(UNKNOWN), unpacked(row["words"], True)[known])
        row |= {"tokens": packed(tokens), "words": packed(hashes, True), "totals": several([t[known] for t in totals])}
        keys = pa.ListArray.from_arrays(pa.array([0, len(row["keys"])], pa.int32()), row["keys"])
        kinds = {"binary": pa.binary(), "bigint": pa.int64()}
        columns = [keys if f.name == "keys" else pa.array([row[f.name]], kinds[f.dataType.simpleString()]) for f in schema]
        return pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    return with_answers(blocks, answers, 4, made, schema)


def pair_questions(block: Block) -> tuple[np.ndarray, list[np.ndarray]]:
    _, _, keys, at = block.pairs()
    return keys, block.counted(at, len(keys))


def scored(blocks: DataFrame, answers: DataFrame, unknown: list[int], starts: list[int], tokens: list[int], vocabulary: int, least: int) -> DataFrame:
    """`(key, n_tokens, total)` of each row: the sum of the loss differences of its tokens."""
    schema = T.StructType([T.StructField("key", blocks.schema["keys"].dataType.elementType), *T.StructType.fromDDL("n_tokens bigint, total double").fields])

    def made(row: dict, pairs: list[np.ndarray]) -> pa.RecordBatch:
        block = read_block(row)
        history, word, _, at = block.pairs()
        known = parted(row["totals"], 4)
        losses = []
        for k in (0, 1):
            words = np.append(unknown[k], known[k]).astype(float)
            histories = np.concatenate([[unknown[2 + k]], known[2 + k], [starts[k]]]).astype(float)
            n = np.where(pairs[k] >= least, pairs[k], 0)
            alone = (1 - BIGRAM_WEIGHT) * (words + 1) / (tokens[k] + vocabulary)
            losses.append(np.log(BIGRAM_WEIGHT * n / np.maximum(histories[history], 1) + alone[word]))
        sums = np.bincount(block.owner, (losses[0] - losses[1])[at], len(block.sizes)).astype(float)
        return pa.RecordBatch.from_arrays([row["keys"], pa.array(block.sizes), pa.array(sums)], ["key", "n_tokens", "total"])

    return with_answers(blocks, answers, 2, made, schema)


def score_documents(
    docs: DataFrame, is_target: str, key: str = "doc_id", text: str = "text", word_share: float = WORD_SHARE, least: int = LEAST,
) -> DataFrame:
    """`(key, n_tokens, score)` per document; rows of one key are one document.

    `is_target` names a boolean column (null: no). A text without words, or a null one, has no
    score. With no target text every word is unknown and every score is that of the unknown word. Keys may be of any type that
    can be grouped, null among them.
    """
    blocks = stored(blocks_of(docs, key, text, is_target), "blocks")
    columns = ("n", "n_target", "starts", "starts_target", "n_words")
    n, n_target, *starts, n_words = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in columns]).first()
    floor = max(2.0, word_share * n_target)
    words = stored(answered(asked(blocks, 1 + n_words // BUCKET_KEYS, lambda b: (b.hashes, b.word_counts())), 4, floor), "words")
    known, *unknown = words.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("known", "n", "n_target", "h", "h_target")]).first()
    numbered = stored(with_known_words(blocks, words, floor), "numbered")
    discarded(blocks)
    discarded(words)
    answers = answered(asked(numbered, 1 + n // BUCKET_KEYS, pair_questions), 2)
    rows = scored(numbered, answers, unknown, starts, [n, n_target], known + 1, least)
    sums = rows.groupBy("key").agg(F.sum("n_tokens").alias("n_tokens"), F.sum("total").alias("total"))
    score = F.when(F.col("n_tokens") > 0, F.round(F.col("total") / F.col("n_tokens"), 6))
    found = stored(sums.select(F.col("key").alias(key), "n_tokens", score.alias("score")), "scores")
    discarded(numbered)
    return found
