"""Exact duplicates by a cuckoo-filter index of live digests.

The normalised text (A-Z lowered, nothing else) is reduced to its SHA-256.
Digests are dealt by their leading bytes to index partitions; each partition
streams its digests through a ``CuckooIndex``: the filter answers "certainly
new" from two small buckets, a hit is verified against the stored key (whole
digest and byte length) in the bucket the filter names, and a row with a
larger id replaces the live one (delete, then insert). When an insertion runs
out of kicks the filter doubles and is rebuilt from the stored keys.

Scale: texts never move; a scan task first folds its own copies together, so
a group that holds a third of all rows reaches its partition as one row per
scan batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.llm.common import fresh, small_batches, written

SLOTS = 4
MAX_KICKS = 64
#: Digests one index partition is planned for (about 100 bytes each in its task).
DIGESTS_PER_PARTITION = 500_000


class CuckooIndex:
    """Filter of 16-bit fingerprints over buckets of verified keys.

    ``store`` holds per filter slot the key that owns the fingerprint, so a
    filter hit is checked against the whole key and never decides alone.
    """

    def __init__(self, capacity: int = 64):
        self._allocate(max(4, 1 << max(1, (int(capacity / (0.85 * SLOTS)) - 1).bit_length())))
        self.size = 0

    def _allocate(self, buckets: int) -> None:
        self.buckets = buckets
        self.prints = np.zeros((buckets, SLOTS), dtype=np.uint16)
        self.store: list[list] = [[None] * SLOTS for _ in range(buckets)]

    @staticmethod
    def _print(key: bytes) -> int:
        return int.from_bytes(key[8:10], "little") or 1

    def _first(self, key: bytes) -> int:
        return int.from_bytes(key[:8], "little") & (self.buckets - 1)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995) & (self.buckets - 1))

    def _find(self, key: bytes) -> tuple[int, int] | None:
        mark, a = self._print(key), self._first(key)
        for b in (a, self._other(a, mark)):
            row = self.prints[b]
            for s in range(SLOTS):
                if row[s] == mark and self.store[b][s][0] == key:
                    return b, s
        return None

    def get(self, key: bytes):
        at = self._find(key)
        return None if at is None else self.store[at[0]][at[1]][1]

    def delete(self, key: bytes) -> bool:
        at = self._find(key)
        if at is None:
            return False
        self.prints[at] = 0
        self.store[at[0]][at[1]] = None
        self.size -= 1
        return True

    def insert(self, key: bytes, value) -> None:
        """Add a key that is not in the index."""
        left = self._place((key, value))
        if left is not None:
            self._grow(left)
        self.size += 1

    def _place(self, entry) -> tuple | None:
        """Store an entry, moving others to their second bucket; returns the entry left over after MAX_KICKS moves."""
        mark, b = self._print(entry[0]), self._first(entry[0])
        if self._put(b, mark, entry):
            return None
        for kick in range(MAX_KICKS):
            b = self._other(b, mark)
            if self._put(b, mark, entry):
                return None
            s = (mark + kick) % SLOTS
            entry, self.store[b][s] = self.store[b][s], entry
            mark, self.prints[b, s] = int(self.prints[b, s]), mark
        return entry

    def _put(self, b: int, mark: int, entry) -> bool:
        row = self.prints[b]
        for s in range(SLOTS):
            if not row[s]:
                row[s] = mark
                self.store[b][s] = entry
                return True
        return False

    def _grow(self, homeless: tuple) -> None:
        """Double the buckets and place every stored key anew, until all have a place."""
        entries = [*self.items(), homeless]
        while True:
            self._allocate(2 * self.buckets)
            if all(self._place(e) is None for e in entries):
                return

    def items(self) -> Iterator[tuple]:
        return (e for bucket in self.store for e in bucket if e is not None)


def _key(text: str | None) -> bytes:
    raw = (text if isinstance(text, str) else "").encode("utf-8", "surrogatepass").lower()  # bytes.lower() touches A-Z only
    return hashlib.sha256(raw).digest() + len(raw).to_bytes(8, "big")


@F.pandas_udf(T.BinaryType())
def text_key(text: pd.Series) -> pd.Series:
    """SHA-256 of the normalised text, then its byte length (8 bytes): the stored key."""
    return pd.Series([_key(t) for t in text], dtype=object)


def _fold_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Copies that share a batch become one row: the largest id and their number."""
    for b in batches:
        yield b.groupby("key", sort=False, as_index=False).agg(id=("id", "max"), n=("key", "size"))


def _index_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Streams one partition's digests through the index; returns its live rows."""
    index = CuckooIndex()
    for rows in batches:
        for key, doc, n in zip(rows["key"], rows["id"], rows["n"], strict=True):
            key, doc = bytes(key), None if pd.isna(doc) else int(doc)
            live = index.get(key)
            if live is not None:  # the live row gives way to the one that holds the larger id
                index.delete(key)
                ids = [x for x in (live[0], doc) if x is not None]
                doc, n = max(ids) if ids else None, live[1] + n
            index.insert(key, (doc, int(n)))
    found = list(index.items())
    for at in range(0, len(found), 10_000):
        part = found[at:at + 10_000]
        yield pd.DataFrame({"key": [k for k, _ in part], "keep_id": pd.array([v[0] for _, v in part], dtype="Int64"),
                            "group_size": np.array([v[1] for _, v in part], dtype=np.int64)})


def live_digests(keys: DataFrame, partitions: int) -> DataFrame:
    """(key, keep_id, group_size) of every distinct key in ``keys`` (id, key)."""
    folded = keys.select(F.col("id").cast("long").alias("id"), "key").mapInPandas(_fold_batches, "key binary, id long, n long")
    return folded.repartition(partitions, "key").mapInPandas(_index_partition, "key binary, keep_id long, group_size long")


def _keyed(docs: DataFrame) -> DataFrame:
    small_batches(docs)
    return written(docs.select(F.col("doc_id").cast("long").alias("id"), text_key("text").alias("key")), "digests")


def _groups(keys: DataFrame) -> DataFrame:
    least = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keys.join(live_digests(keys, max(least, -(-keys.count() // DIGESTS_PER_PARTITION))), "key")


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lowering A-Z. Null text counts as
    empty. The row with the largest doc_id stays; a null doc_id is smaller
    than any other. Repeated rows (same id and text) are one document and
    all carry ``kept``. An empty table gives an empty result; other columns
    are never read, so their names cannot clash.
    """
    return _groups(_keyed(docs)).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex(F.substring("key", 1, 32))).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without exact copies, all columns as they are.

    Of equal texts the row of largest doc_id stays, as in ``exact_groups``;
    of rows that repeat id and text one stays.
    """
    keys = _keyed(docs)
    gone = _groups(keys).where(~F.col("id").eqNullSafe(F.col("keep_id"))).select("id", "key")
    id_, key = fresh("id_", docs.columns), fresh("key_", docs.columns)
    rows = docs.withColumn(id_, F.col("doc_id").cast("long")).withColumn(key, text_key("text"))
    left = rows.join(gone, rows[id_].eqNullSafe(gone["id"]) & (rows[key] == gone["key"]), "left_anti")
    return left.dropDuplicates([id_, key]).drop(id_, key)
