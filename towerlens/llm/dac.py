"""Token files of directly addressable codes.

An id is cut into chunks of ``CHUNK_BITS`` from the low end. Level k stores
the k-th chunk of every id that has one, and a bitmap that says which of them
continue on level k+1; a rank directory (ones before every ``RANK_BITS`` bits)
finds the place of a continuing id on the next level in constant time. Any
token is read by one lookup a level; no block is decoded.

File (little-endian): magic, version, chunk bits, levels, documents, ids;
document ids (int64) and a null mark each; document starts (uint64, documents
+ 1); then for each level its length, chunk bytes, bitmap and rank directory.

Scale: documents are dealt by ranges of doc_id, each task writes its range in
order as files of at most ``FILE_IDS`` ids into the shared folder, and returns
a manifest row per file. Only files in the manifest are read, so attempts that
were lost or repeated leave no trace in the result.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from towerlens.llm.common import shared_folder, small_batches, written
from towerlens.llm.tokens import encode_documents

MAGIC, VERSION = b"TLDAC", 1
CHUNK_BITS = 8
RANK_BITS = 512
#: Ids of one file, beyond which a task starts the next (a longer document has a file of its own).
FILE_IDS = 4_000_000
#: Rows planned for one range of doc_id.
RANGE_ROWS = 50_000

_HEAD = struct.Struct("<5sBBBQQ")


def encode(doc_ids: list[int | None], documents: list[np.ndarray]) -> bytes:
    """The bytes of one file."""
    starts = np.zeros(len(documents) + 1, dtype="<u8")
    np.cumsum([len(d) for d in documents], out=starts[1:])
    values = np.concatenate(documents) if documents else np.zeros(0, dtype="<u4")
    levels = []
    while True:
        rest = values >> CHUNK_BITS
        more = rest > 0
        padded = np.zeros(-(-max(1, len(values)) // RANK_BITS) * RANK_BITS, dtype=bool)
        padded[:len(values)] = more
        directory = np.zeros(len(padded) // RANK_BITS + 1, dtype="<u8")
        np.cumsum(padded.reshape(-1, RANK_BITS).sum(axis=1), out=directory[1:])
        levels.append((values & ((1 << CHUNK_BITS) - 1)).astype(np.uint8).tobytes()
                      + np.packbits(padded, bitorder="little").tobytes() + directory.tobytes())
        lengths = len(values)
        levels[-1] = struct.pack("<Q", lengths) + levels[-1]
        values = rest[more]
        if not len(values):
            break
    ids = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    nulls = np.array([d is None for d in doc_ids], dtype=np.uint8)
    head = _HEAD.pack(MAGIC, VERSION, CHUNK_BITS, len(levels), len(documents), int(starts[-1]))
    return b"".join([head, ids.tobytes(), nulls.tobytes(), starts.tobytes(), *levels])


class Reader:
    """Random access to a file held as a buffer (bytes or a memory map)."""

    def __init__(self, data):
        magic, version, self.bits, levels, self.n_docs, self.n_ids = _HEAD.unpack_from(data, 0)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token file of this version")
        at = _HEAD.size

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(data, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        self.doc_ids, self.doc_nulls, self.starts = take("<i8", self.n_docs), take(np.uint8, self.n_docs), take("<u8", self.n_docs + 1)
        self.levels = []
        for _ in range(levels):
            n = int(take("<u8", 1)[0])
            blocks = -(-max(1, n) // RANK_BITS)
            self.levels.append((take(np.uint8, n), take(np.uint8, blocks * RANK_BITS // 8), take("<u8", blocks + 1)))

    @staticmethod
    def _rank(bitmap: np.ndarray, directory: np.ndarray, i: int) -> int:
        """Ones before bit i."""
        block = i // RANK_BITS
        bits = np.unpackbits(bitmap[block * RANK_BITS // 8:-(-i // 8)], bitorder="little")
        return int(directory[block]) + int(bits[:i - block * RANK_BITS].sum())

    def token(self, i: int) -> int:
        """The i-th id of the file."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = 0
        for k, (chunks, bitmap, directory) in enumerate(self.levels):
            value |= int(chunks[i]) << (k * self.bits)
            if not bitmap[i // 8] >> (i % 8) & 1:
                break
            i = self._rank(bitmap, directory, i)
        return value

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop: on each level one contiguous run, found by rank."""
        out = np.zeros(stop - start, dtype="<u4")
        at = np.arange(stop - start)
        for k, (chunks, bitmap, directory) in enumerate(self.levels):
            if start == stop:
                break
            out[at] |= chunks[start:stop].astype("<u4") << np.uint32(k * self.bits)
            first = start // 8
            more = np.unpackbits(bitmap[first:-(-stop // 8)], bitorder="little")[start - 8 * first:stop - 8 * first].astype(bool)
            at, start = at[more], self._rank(bitmap, directory, start)
            stop = start + len(at)
        return out

    def document(self, n: int) -> np.ndarray:
        return self.tokens(int(self.starts[n]), int(self.starts[n + 1]))


def _filesystem(path: str):
    """The file system of a folder or file, and its path there (local, HDFS and object stores by their scheme)."""
    from pyarrow import fs
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _write_task(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, root = _filesystem(folder)
        where.create_dir(root, recursive=True)
        task, number = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        docs: list[np.ndarray] = []

        def flush() -> pd.DataFrame:
            name = f"part-{task:06d}-{number:06d}-{uuid.uuid4().hex}.dac"
            with where.open_output_stream(f"{root}/{name}") as out:
                out.write(encode(ids, docs))
            return pd.DataFrame({"part": [task], "number": [number], "path": [f"{folder}/{name}"],
                                 "n_docs": [len(docs)], "n_ids": [sum(map(len, docs))]})

        held = 0
        for b in batches:
            for doc_id, doc in zip(b["doc_id"], encode_documents(b["text"], tokenizer, end_id), strict=True):
                if docs and held + len(doc) > FILE_IDS:
                    yield flush()
                    ids, docs, held, number = [], [], 0, number + 1
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                docs.append(doc.copy())
                held += len(doc)
        if docs:
            yield flush()
    return run


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write the ids of every document (text ids, then ``end_id``) in ascending doc_id order; returns the manifest:
    part, number, path, n_docs, n_ids, first_id (ids in all files before).

    Null text is empty; null doc_ids come first; rows that share an id follow each other by text. An empty table
    writes no file. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(docs)
    folder = f"{shared_folder(spark)}/llm/tokens-{uuid.uuid4().hex}"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // RANGE_ROWS))
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    manifest = written(ordered.mapInPandas(_write_task(folder, tokenizer, end_id),
                                           "part int, number int, path string, n_docs long, n_ids long"), "manifest")
    # One row a range is laid end to end in one task; files are laid end to end within their range.
    per_part = manifest.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = per_part.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("number")) - F.col("n_ids")
    return manifest.withColumn("inside", inside).join(before, "part") \
        .select("part", "number", "path", "n_docs", "n_ids", (F.col("before") + F.col("inside")).alias("first_id"))


def _read_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for path, first in zip(b["path"], b["first_id"], strict=True):
            where, name = _filesystem(path)
            with where.open_input_file(name) as f:
                file = Reader(f.read_buffer())
            for at in range(0, file.n_docs, 1024):
                span = range(at, min(at + 1024, file.n_docs))
                found = [file.document(n) for n in span]
                yield pd.DataFrame({
                    "doc_id": pd.array([None if file.doc_nulls[n] else int(file.doc_ids[n]) for n in span], dtype="Int64"),
                    "start": [int(first) + int(file.starts[n]) for n in span], "n_tokens": [len(x) for x in found],
                    "ids": [x.tobytes() for x in found]})


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Documents of the manifest's files: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit)."""
    files = manifest.select("path", "first_id")
    spread = max(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return files.repartition(spread, "path").mapInPandas(_read_files, "doc_id long, start long, n_tokens long, ids binary")
