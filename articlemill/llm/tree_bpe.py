"""Byte-level BPE as a tree reduction: ranks of a `.tiktoken` file, one result per match of a pattern.

A match is halved down to tokens; neighbouring encodings are joined on the way up. What a join may
leave alone rests on one fact. Call tokens x, y compatible if the merges of the bytes of xy give x, y
again. A sequence of tokens is the encoding of its bytes exactly if all neighbours in it are compatible:
up to the first merge across a boundary the merges run inside each token as they would alone, so that
merge would happen in the two tokens beside the boundary as well. A join therefore encodes anew a
window of tokens around the boundary, and is done on a side as soon as the window's outermost token is compatible with
its neighbour outside, as it surely is if it came out as it was; until then the window doubles on that side. The join is associative, with the empty sequence as its unit.

Decoding concatenates the bytes of tokens up the same kind of tree.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from articlemill.llm.bpe import PRETOKEN, Encoder, unpack
from articlemill.llm.common import extended, pieces, texts_of

#: Words that a worker remembers, and pairs of tokens, and parts of words; others are worked out each time they are met.
WORD_MEMO, PAIR_MEMO = 300_000, 300_000
#: Bytes of a part of a word up to which it is worth remembering.
SHORT = 8
#: Ids that are decoded in one leaf of the tree.
LEAF_IDS = 4096


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file with their ids. Every single byte has to be a token."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, file))}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"no byte-level ranks: {path}")
    return ranks


class Tree:
    """Encodes the bytes of a match, and decodes ids."""

    def __init__(self, ranks: dict[bytes, int], memo: int = PAIR_MEMO):
        self.ranks, self.memo = ranks, memo
        self.token = {rank: token for token, rank in ranks.items()}
        self.pairs: dict[tuple[int, int], list[int]] = {}
        self.parts: dict[bytes, list[int]] = {}
        self.own: dict[int, bool] = {}

    def encode(self, match: bytes) -> list[int]:
        """The ids of a match. One that is a token as a whole is that token, whether or not merges lead to it."""
        whole = self.ranks.get(match)
        return [whole] if whole is not None else self.reduced(match)

    def reduced(self, part: bytes) -> list[int]:
        """What the merges make of `part`: the joined encodings of its halves."""
        known = self.parts.get(part)
        if known is not None:
            return known
        token = self.ranks.get(part)
        found = [token] if token is not None and self.is_own(token) else self.halves(part) if part else []
        if len(part) <= SHORT and len(self.parts) < self.memo:
            self.parts[part] = found
        return found

    def halves(self, part: bytes) -> list[int]:
        middle = len(part) // 2
        return self.join(self.reduced(part[:middle]), self.reduced(part[middle:]))

    def is_own(self, token: int) -> bool:
        """Whether the merges of a token's bytes lead to the token."""
        known = self.own.get(token)
        if known is None:
            part = self.token[token]
            known = self.own[token] = len(part) == 1 or self.halves(part) == [token]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring parts from theirs."""
        if not left or not right:
            return left or right
        a = b = 1
        new = self.pair(left[-1], right[0])
        while True:
            more_left = a < len(left) and new[0] != left[-a] and not self.compatible(left[-a - 1], new[0])
            more_right = b < len(right) and new[-1] != right[b - 1] and not self.compatible(new[-1], right[b])
            if not more_left and not more_right:
                return left[:-a] + new + right[b:]
            a = min(2 * a, len(left)) if more_left else a
            b = min(2 * b, len(right)) if more_right else b
            new = self.window([*left[-a:], *right[:b]])

    def compatible(self, left: int, right: int) -> bool:
        return len(new := self.pair(left, right)) == 2 and new[0] == left

    def pair(self, left: int, right: int) -> list[int]:
        found = self.pairs.get((left, right))
        if found is None:
            found = self.window([left, right])
            if len(self.pairs) < self.memo:
                self.pairs[left, right] = found
        return found

    def window(self, tokens: Sequence[int]) -> list[int]:
        """The tokens' bytes encoded from the ground: merges in the order of rank, then from the left."""
        part = b"".join(map(self.token.__getitem__, tokens))
        n, rank_of = len(part), self.ranks.get
        end = list(range(1, n + 1))  # of the piece that starts at each place; 0 where none starts
        before = list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank_of(part[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue  # one of the two pieces has grown or gone
            end[i], end[middle], before[stop] = stop, 0, i
            if stop < n and (r := rank_of(part[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
            if i and (r := rank_of(part[before[i] : stop])) is not None:
                heapq.heappush(heap, (r, before[i], stop))
        return [self.ranks[part[i : end[i]]] for i in range(n) if end[i]]

    def decode(self, ids: Sequence[int]) -> bytes:
        """The bytes of the ids."""
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self.token.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


@functools.lru_cache(maxsize=2)
def worker_tree(path: str) -> Tree:
    return Tree(read_ranks(path))


@functools.lru_cache(maxsize=2)
def worker_encoder(path: str, pattern: str) -> Encoder:
    """Packs texts. Where the pattern parts words at single blanks, a text is cut there and words are remembered."""
    tree, matches = worker_tree(path), regex.compile(pattern).findall

    def pack_word(word: str) -> bytes:
        ids = tree.encode(word.encode("utf-8", "surrogatepass"))
        return struct.pack(f"<{len(ids)}I", *ids)

    return Encoder(lambda text: b"".join(map(pack_word, matches(text))), pack_word if pattern == PRETOKEN else None, limit=WORD_MEMO)


def encode_documents(df: DataFrame, path: str, pattern: str = PRETOKEN, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the column `ids` (array of int) with the token ids of each text.

    One scan, no shuffle. A null text counts as empty and has no ids; other columns pass
    through, and a column that is already named `ids` is replaced.
    """
    kept = [c for c in df.columns if c != ids]
    df = df.select(*[f"`{c}`" for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, pattern)
        for piece in pieces(batches, text):
            lists = [unpack(encoder.pack(t)) if t else [] for t in texts_of(piece, text)]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(lists, pa.list_(pa.int32()))], [*kept, ids])

    return df.mapInArrow(run, extended(df, f"`{ids}` array<int>"))


def decode_documents(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the column `decoded` (binary) with the bytes of `ids`. Null ids give null, none give no bytes."""
    kept = [c for c in df.columns if c != decoded]
    df = df.select(*[f"`{c}`" for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = worker_tree(path)
        for piece in pieces(batches, ids):
            found = [None if i is None else tree.decode(i) for i in texts_of(piece, ids)]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(found, pa.binary())], [*kept, decoded])

    return df.mapInArrow(run, extended(df, f"`{decoded}` binary"))


def round_trip_digests(df: DataFrame, path: str, pattern: str = PRETOKEN, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`(key, n_tokens, ids_sha256, decoded_sha256)` of each row: encoded, then decoded from the ids.

    The first digest is of the ids as little-endian unsigned 32-bit integers, the second of the decoded
    bytes. Both are taken where the ids are made. A null text counts as empty, a null key stays null;
    repeated rows give repeated rows, an empty table an empty one. Other columns do not matter.
    """
    df = df.select(f"`{key}`", f"`{text}`")
    added = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def digest(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, encoder = worker_tree(path), worker_encoder(path, pattern)
        names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
        for piece in pieces(batches, text):
            packed = [encoder.pack(t) if t else b"" for t in texts_of(piece, text)]
            decoded = [digest(tree.decode(unpack(p))) for p in packed]
            counts = np.array([len(p) // 4 for p in packed], np.int64)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(counts), pa.array(map(digest, packed), pa.string()), pa.array(decoded, pa.string())], names)

    return df.mapInArrow(run, extended(df.select(f"`{key}`"), added))
