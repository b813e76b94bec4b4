"""Token ids in flat binary files that are read by memory mapping.

The format, for part number i of a data set in a folder:

- `ids-<i>.bin`: the ids of the part's documents one after the other, as little-endian
  unsigned integers of 2 bytes where all ids of the vocabulary fit, else 4.
- `offsets-<i>.bin`: little-endian signed 64-bit integers: the key of each document, then
  the end of each document in ids from the part's start.

Documents ascend by key within a part and from part to part; the place of a part in the
whole (its base) is the sum of the ids in the parts before it.
"""

from __future__ import annotations

import functools
import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articlemill.llm.bpe import Encoder, byte_letters, is_byte_level
from articlemill.llm.common import new_folder, pieces, qualified, texts_of
from articlemill.sources.tables import UNKNOWN_SIZE

#: Bytes of text for which one file is made.
FILE_BYTES = 64 << 20
NULL_KEY = -(1 << 63)


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder: local, or any that pyarrow knows by its URI."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


@functools.lru_cache(maxsize=2)
def library_encoder(path: str) -> Encoder:
    """The encoder of the tokenizers library, asked once for each remembered part of a text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    loaded = json.loads(tokenizer.to_str())
    model, letters = tokenizer.model.tokenize, {b: c for c, b in byte_letters().items()}

    def encode_text(text: str) -> bytes:
        ids = tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_word(word: str) -> bytes:
        """A pre-token goes to the library's model itself, which is quicker than the whole chain."""
        ids = [t.id for t in model(word.encode().decode("latin-1").translate(letters))]
        return struct.pack(f"<{len(ids)}I", *ids)

    special = [t["content"] for t in loaded["added_tokens"]]
    return Encoder(encode_text, encode_word if is_byte_level(loaded) else None, special)


def mapped(folder: str, name: str, dtype: str) -> np.ndarray:
    """The integers of a file: memory-mapped on a mounted folder, read elsewhere."""
    files, path = open_folder(folder)
    if files.get_file_info(path + "/" + name).size == 0:
        return np.empty(0, dtype)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(f"{path}/{name}", dtype, "r")
    with files.open_input_file(f"{path}/{name}") as file:
        return np.frombuffer(file.read(), dtype)


@functools.lru_cache(maxsize=4)
def id_bytes(path: str, end_id: int | None) -> int:
    """2 if every id, the end id too, is below 65,536; else 4."""
    from tokenizers import Tokenizer

    size = Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
    return 2 if max(size - 1, end_id or 0) < 1 << 16 else 4


class PartWriter:
    """Writes one part under other names, and gives the files their names when all is written.

    A lost task leaves no half file that a reader would take. A task that runs again
    writes the same bytes, so either attempt may win.
    """

    def __init__(self, folder: str, part: int, width: int):
        (self.files, self.root), self.part, self.width = open_folder(folder), part, width
        self.mark, self.keys, self.sizes = uuid.uuid4().hex, [], []
        self.ids = self.files.open_output_stream(self.draft("ids"))

    def draft(self, kind: str) -> str:
        return f"{self.root}/.{kind}-{self.part:08d}.{self.mark}"

    def add(self, keys: list[int | None], packed: list[bytes]) -> None:
        self.keys.append(np.array([NULL_KEY if k is None else k for k in keys], "<i8"))
        self.sizes.append(np.array([len(p) // 4 for p in packed], "<i8"))
        self.ids.write(np.frombuffer(b"".join(packed), "<u4").astype(f"<u{self.width}").tobytes())

    def close(self) -> tuple[int, int]:
        self.ids.close()
        keys, ends = np.concatenate([*self.keys, []]).astype("<i8"), np.cumsum(np.concatenate([*self.sizes, []]), dtype="<i8")
        with self.files.open_output_stream(self.draft("offsets")) as out:
            out.write(keys.tobytes() + ends.tobytes())
        for kind in ("ids", "offsets"):
            self.files.move(self.draft(kind), f"{self.root}/{kind}-{self.part:08d}.bin")
        return len(keys), int(ends[-1]) if len(ends) else 0


def part_count(df: DataFrame, file_bytes: int) -> int:
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return least if size >= UNKNOWN_SIZE else max(least, -(-size // file_bytes))


def write_token_files(
    df: DataFrame, path: str, end_id: int | None = None, folder: str | None = None,
    key: str = "doc_id", text: str = "text", file_bytes: int = FILE_BYTES,
) -> str:
    """Encodes every text, appends `end_id`, and writes the files in ascending key order. Returns the folder.

    The one shuffle deals whole texts by ranges of the key, which Spark samples, so parts
    are even for any order and spread of keys; each task then encodes its part and streams
    it to its files. A null text is empty, a null key comes first (and stays null), rows of equal
    keys go by a hash of the text. An empty table gives a folder without documents.
    """
    folder = qualified(df.sparkSession, folder or new_folder(df.sparkSession, "tokens"))
    files, root = open_folder(folder)
    files.create_dir(root, recursive=True)
    width = id_bytes(path, end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(path)
        end = b"" if end_id is None else struct.pack("<I", end_id)
        part = TaskContext.get().partitionId()
        out = PartWriter(folder, part, width)
        for piece in pieces(batches, "text"):
            out.add(piece.column(0).to_pylist(), [(encoder.pack(t) if t else b"") + end for t in texts_of(piece)])
        n_docs, n_ids = out.close()
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (part, n_docs, n_ids)], ["part", "n_docs", "n_ids"])

    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    order = [F.asc_nulls_first("key"), F.xxhash64("text").asc()]
    placed = rows.repartitionByRange(part_count(df, file_bytes), *order).sortWithinPartitions(*order)
    placed.mapInArrow(write, "part bigint, n_docs bigint, n_ids bigint").write.parquet(f"{folder}/manifest")
    return folder


def read_token_files(spark: SparkSession, folder: str, path: str, end_id: int | None = None) -> DataFrame:
    """`(key, start, n_tokens, ids_crc32)` per document, read from the files in parallel.

    The bases of the parts are prefix sums over the manifest, which has one row per file.
    """
    folder, width = qualified(spark, folder), id_bytes(path, end_id)
    manifest = spark.read.parquet(f"{folder}/manifest")
    rows = sorted(manifest.select("part", "n_ids").collect())
    bases = np.concatenate([[0], np.cumsum([n for _, n in rows], dtype="i8")])[:-1] if rows else []
    listed = spark.createDataFrame([(p, int(b)) for (p, _), b in zip(rows, bases, strict=True)], "part bigint, base bigint")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = mapped(folder, f"ids-{part:08d}.bin", f"<u{width}")
                index = mapped(folder, f"offsets-{part:08d}.bin", "<i8")
                keys, ends = np.split(np.asarray(index), 2)
                starts = np.concatenate([[0], ends[:-1]])
                for at in range(0, len(keys), 10_000):
                    some = slice(at, at + 10_000)
                    crcs = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts[some], ends[some], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[some], mask=keys[some] == NULL_KEY), pa.array(starts[some] + base),
                         pa.array(ends[some] - starts[some]), pa.array(crcs, pa.int64())],
                        ["key", "start", "n_tokens", "ids_crc32"],
                    )

    tasks = listed.repartitionById(max(1, len(rows)), F.col("part").cast("int"))
    return tasks.mapInArrow(read, "key bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
