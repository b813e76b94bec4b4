"""Byte-level BPE: encoding by a contiguous rank array, and decoding.

The vocabulary and the merge list come from a tokenizer file (its path is a parameter).
A text is cut at single blanks first: no token of this kind of tokenizer reaches across
one, so the part after a blank, with the blank, encodes alike in every text. Encodings
of parts are remembered per worker in a bounded memo; a part beyond its bound is encoded
each time it is met, with the same result.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from articlemill.llm.common import extended, pieces, texts_of

#: Parts in a worker's memo.
MEMO = 500_000
#: Words of more bytes than this merge by a heap, since scanning them again for each merge would take quadratic time.
SCAN_BYTES = 256
NO_RANK = 1 << 60
#: Marks that are a word of their own at the end of a part.
MARKS = tuple(",.;:!?")

#: Fixed value: the pattern of the byte-level pre-tokenizer.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that a tokenizer file writes for each byte: printable ones stand for themselves."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = (b for b in range(256) if b not in set(printable))
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass(frozen=True)
class Vocabulary:
    ranks: list[dict[int, int]]  #: left id, then right id, to the rank of their merge
    merged: list[int]  #: rank to the id of the merged token
    of_byte: list[int]  #: byte to its id
    token: list[bytes]  #: id to its bytes
    special: dict[str, int]


def is_byte_level(loaded: dict) -> bool:
    """True if a tokenizer file describes BPE over bytes whose words start at a blank."""
    before, model = loaded.get("pre_tokenizer") or {}, loaded["model"]
    return (
        model["type"] == "BPE"
        and loaded.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and not (model.get("ignore_merges") or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"))
        and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or " " in t["content"] for t in loaded["added_tokens"])
    )


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        loaded = json.load(file)
    if not is_byte_level(loaded):
        raise ValueError(f"no byte-level BPE: {path}")
    ids, letters = loaded["model"]["vocab"], byte_letters()
    special = {t["content"]: t["id"] for t in loaded["added_tokens"]}
    token = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for letter_form, i in ids.items():
        token[i] = bytes(map(letters.__getitem__, letter_form))
    for content, i in special.items():
        token[i] = content.encode()
    ranks, merged = [{} for _ in token], []
    for rank, pair in enumerate(loaded["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        ranks[ids[left]].setdefault(ids[right], rank)
        merged.append(ids[left + right])
    of_byte = [0] * 256
    for letter, b in letters.items():
        of_byte[b] = ids[letter]
    return Vocabulary(ranks, merged, of_byte, token, special)


def merge_word(v: Vocabulary, word: bytes) -> list[int]:
    """Ids of one pre-token.

    `parts[i]` is the id of the part between boundaries i and i + 1, `ranks[i]` the rank
    of its merge with the next part. The lowest rank (the leftmost of equal ones) is
    found by a scan; its boundary goes, and the ranks on both sides are looked up anew.
    """
    parts = [v.of_byte[b] for b in word]
    if len(parts) > SCAN_BYTES:
        return merge_long_word(v, parts)
    ranks_after, merged = v.ranks, v.merged
    ranks = [ranks_after[a].get(b, NO_RANK) for a, b in zip(parts, parts[1:], strict=False)]
    while ranks:
        lowest = min(ranks)
        if lowest == NO_RANK:
            break
        i = ranks.index(lowest)
        parts[i] = part = merged[lowest]
        del parts[i + 1], ranks[i]
        if i < len(ranks):
            ranks[i] = ranks_after[part].get(parts[i + 1], NO_RANK)
        if i:
            ranks[i - 1] = ranks_after[parts[i - 1]].get(part, NO_RANK)
    return parts


def merge_long_word(v: Vocabulary, parts: list[int]) -> list[int]:
    """The same result in n log n: candidates wait in a heap, stale ones are skipped."""
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := v.ranks[parts[i]].get(parts[i + 1], NO_RANK)) != NO_RANK]
    heapq.heapify(heap)
    while heap:
        rank, i, left, right = heapq.heappop(heap)
        j = after[i]
        if parts[i] != left or j >= n or parts[j] != right:
            continue
        parts[i], parts[j], after[i] = v.merged[rank], -1, after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (r := v.ranks[parts[a]].get(parts[b], NO_RANK)) != NO_RANK:
                heapq.heappush(heap, (r, a, parts[a], parts[b]))
    return [p for p in parts if p >= 0]


class Unsplittable(Exception):
    """A blank of the text stands beside other white space."""


class WordMemo(dict):
    """Pre-tokens to their packed ids, up to a bound; `prefix` is put before a key."""

    def __init__(self, encode_word, limit: int, prefix: str = ""):
        super().__init__()
        self.encode_word, self.limit, self.prefix = encode_word, limit, prefix

    def __missing__(self, word: str) -> bytes:
        ids = self.encode_word(self.prefix + word)
        if len(self) < self.limit:
            self[word] = ids
        return ids


class PartMemo(WordMemo):
    """The part of a text after a blank to its packed ids. Only parts that are one word are kept;
    others, which end in a mark as a rule, are put together from the ids of their words."""

    def __init__(self, encode_word, limit: int, words, special: list[str], encode_text):
        super().__init__(encode_word, limit, " ")
        self.words, self.special, self.encode_text = words, special, encode_text
        self.others = WordMemo(encode_word, limit // 10)

    def __missing__(self, part: str) -> bytes:
        if part.isalpha():
            return super().__missing__(part)
        if part[-1:] in MARKS and part[:-1].isalpha():
            return self[part[:-1]] + self.others[part[-1]]
        if not part or part[0].isspace() or part[-1].isspace():
            raise Unsplittable
        if any(s in part for s in self.special):
            return self.encode_text(" " + part)
        others = self.others
        return b"".join([self[w[1:]] if w[0] == " " and w[1:].isalpha() else others[w] for w in self.words(" " + part)])


class Encoder:
    """Packs the ids of texts as little-endian unsigned 32-bit integers.

    `encode_text` gives the packed ids of any text, `encode_word` those of a pre-token. Without the
    latter, where the tokenizer may reach across blanks, each text is encoded whole.
    """

    def __init__(self, encode_text, encode_word=None, special: list[str] = (), limit: int = MEMO):
        self.encode_text = encode_text
        words = regex.compile(PRETOKEN).findall
        self.memo = PartMemo(encode_word, limit, words, list(special), encode_text) if encode_word else None

    def pack(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        if not rest or self.memo is None or not first or first[-1].isspace():
            return self.encode_text(text)
        try:
            return self.encode_text(first) + b"".join(map(self.memo.__getitem__, rest))
        except Unsplittable:
            return self.encode_text(text)


def rank_array_encoder(path: str, limit: int = MEMO) -> Encoder:
    """An encoder by the merge list itself. Text that spells a special token becomes that token."""
    v = vocabulary(path)
    words = regex.compile(PRETOKEN).findall
    special = regex.compile("(" + "|".join(map(regex.escape, sorted(v.special, key=len, reverse=True))) + ")") if v.special else None

    def encode_word(word: str) -> bytes:
        ids = merge_word(v, word.encode("utf-8", "surrogatepass"))
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_text(text: str) -> bytes:
        parts = special.split(text) if special and special.search(text) else [text]
        return b"".join([
            struct.pack("<I", v.special[p]) if p in v.special else b"".join(map(encode_word, words(p))) for p in parts
        ])

    return Encoder(encode_text, encode_word, list(v.special), limit)


@functools.lru_cache(maxsize=2)
def worker_encoder(path: str) -> Encoder:
    return rank_array_encoder(path)


def unpack(packed: bytes) -> list[int]:
    return memoryview(packed).cast("I").tolist()


def decode_bytes(v: Vocabulary, ids: Iterable[int]) -> bytes:
    return b"".join(map(v.token.__getitem__, ids))


def decode(v: Vocabulary, ids: Iterable[int]) -> str:
    """The text of the ids; bytes that are no UTF-8 become replacement characters."""
    return decode_bytes(v, ids).decode("utf-8", "replace")


def encode_documents(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the column `ids` (array of int) with the token ids of each text.

    One scan, no shuffle. A null text counts as empty and has no ids; other columns pass
    through, and a column that is already named `ids` is replaced.
    """
    kept = [c for c in df.columns if c != ids]
    df = df.select(*[f"`{c}`" for c in kept])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path)
        for piece in pieces(batches, text):
            lists = [unpack(encoder.pack(t)) if t else [] for t in texts_of(piece, text)]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(lists, pa.list_(pa.int32()))], [*kept, ids])

    return df.mapInArrow(encode, extended(df, f"`{ids}` array<int>"))


def decode_documents(df: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Adds the column `text` decoded from `ids`. Null ids give null."""
    kept = [c for c in df.columns if c != text]
    df = df.select(*[f"`{c}`" for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for piece in pieces(batches, ids):
            found = [None if i is None else decode(v, i) for i in texts_of(piece, ids)]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(found, pa.string())], [*kept, text])

    return df.mapInArrow(run, extended(df, f"`{text}` string"))


def round_trip_digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """`(key, n_tokens, ids_sha256, decoded_sha256)` of each row: encoded, then decoded from the ids.

    Digests are taken where the ids are made, so the ids do not leave the task unless asked for as
    the column `ids`. A null text counts as empty. Repeated rows give repeated rows.
    """
    df = df.select(f"`{key}`", f"`{text}`")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, encoder = vocabulary(path), worker_encoder(path)
        decimal = [str(i).encode() for i in range(len(v.token))].__getitem__
        for piece in pieces(batches, text):
            packed, counts, encoded, decoded = [], [], [], []
            for t in texts_of(piece, text):
                packed.append(encoder.pack(t) if t else b"")
                ids = unpack(packed[-1])
                counts.append(len(ids))
                encoded.append(hashlib.sha256(b",".join(map(decimal, ids))).hexdigest())
                back = decode_bytes(v, ids)
                if back != (t or "").encode():
                    back = back.decode("utf-8", "replace").encode()
                decoded.append(hashlib.sha256(back).hexdigest())
            columns = [piece.column(0), pa.array(counts, pa.int64()), pa.array(encoded), pa.array(decoded)]
            if with_ids:
                ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                columns.append(pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(packed), "<i4"))))
            yield pa.RecordBatch.from_arrays(columns, [key, *names])

    added = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    names = [part.split()[0] for part in added.split(", ")]
    return df.mapInArrow(run, extended(df.select(f"`{key}`"), added))
