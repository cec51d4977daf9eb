"""Bounded-space online packing of documents into sequences of fixed length.

Each scan task keeps at most ``open_windows`` unfinished sequences. A document
first fills whole sequences of its own; its rest goes to the open window it
fits best. When it fits none and no window may be opened, its head tops up
the fullest window, which is emitted full, and the remainder is placed again.
At the end of a task the open windows are merged, leaving fewer than
``length`` ids; those leftovers of all tasks are merged in rounds of
``FAN_IN`` tasks a group until one unfinished sequence is left in the table.

Scale: documents are never shuffled; a task holds one batch, the open windows
and nothing else; a leftover round moves under ``length`` ids a task.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens.llm.common import small_batches, written
from towerlens.llm.tokens import encode_documents

LENGTH = 2048
OPEN_WINDOWS = 64
FAN_IN = 256

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, "
          "sequence_tokens long, source_task long")

#: A piece: (doc_id, start, ids, doc_tokens).
Piece = tuple


def _sequence_id(round_: int, group: int, number: int) -> int:
    return (round_ << 58) | (group << 34) | number


class Packer:
    """The open windows of one task; ``done`` collects finished sequences (lists of pieces)."""

    def __init__(self, length: int = LENGTH, open_windows: int = OPEN_WINDOWS):
        self.length, self.most = length, open_windows
        self.gaps: list[tuple[int, int]] = []  # (free ids, window), ascending: the fullest first
        self.windows: dict[int, list[Piece]] = {}
        self.opened = 0
        self.done: list[list[Piece]] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        whole = len(ids) - len(ids) % self.length
        for at in range(0, whole, self.length):
            self.done.append([(doc_id, at, ids[at:at + self.length], len(ids))])
        at = whole
        while at < len(ids):
            n = len(ids) - at
            best = bisect_left(self.gaps, (n, -1))
            if best < len(self.gaps):
                gap, w = self.gaps.pop(best)
            elif len(self.gaps) < self.most:
                gap, w = self.length, self.opened
                self.windows[w] = []
                self.opened += 1
            else:
                gap, w = self.gaps.pop(0)  # none fits: the fullest is topped up and goes
            take = min(n, gap)
            self.windows[w].append((doc_id, at, ids[at:at + take], len(ids)))
            at += take
            if gap == take:
                self.done.append(self.windows.pop(w))
            else:
                insort(self.gaps, (gap - take, w))

    def close(self) -> list[Piece]:
        """Merge the open windows, fullest first; returns the pieces of the one left unfinished."""
        full, rest = merge([self.windows[w] for _, w in self.gaps], self.length)
        self.done += full
        self.gaps, self.windows = [], {}
        return rest


def merge(windows: list[list[Piece]], length: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Lay windows end to end and cut at every ``length`` ids."""
    full: list[list[Piece]] = []
    now: list[Piece] = []
    used = 0
    for doc_id, start, ids, total in (p for w in windows for p in w):
        at = 0
        while at < len(ids):
            part = ids[at:at + length - used]
            now.append((doc_id, start + at, part, total))
            at += len(part)
            used += len(part)
            if used == length:
                full.append(now)
                now, used = [], 0
    return full, now


def _rows(sequences: list[list[Piece]], ids: list[int | None], task: int) -> pd.DataFrame:
    out = []
    for number, pieces in zip(ids, sequences, strict=True):
        total, at = sum(len(p[2]) for p in pieces), 0
        for doc_id, start, part, doc_tokens in pieces:
            out.append((doc_id, start, len(part), part.astype("<u4").tobytes(), doc_tokens, number, at, total, task))
            at += len(part)
    frame = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "source_task"])
    return frame.astype({"doc_id": "Int64", "sequence_id": "Int64"})


def _pack_task(tokenizer: str, end_id: int, length: int, open_windows: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, packer, number = TaskContext.get().partitionId(), Packer(length, open_windows), 0
        for b in batches:
            ids = [None if pd.isna(x) else int(x) for x in b["doc_id"]]
            for doc_id, doc in zip(ids, encode_documents(b["text"], tokenizer, end_id), strict=True):
                packer.add(doc_id, doc)
                if len(packer.done) >= 512:
                    yield _rows(packer.done, [_sequence_id(0, task, number + k) for k in range(len(packer.done))], task)
                    number += len(packer.done)
                    packer.done = []
        rest = packer.close()
        yield _rows(packer.done, [_sequence_id(0, task, number + k) for k in range(len(packer.done))], task)
        yield _rows([rest] if rest else [], [None] if rest else [], task)
    return run


def _merge_group(round_: int, length: int, last: bool):
    def run(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        group = int(key[0])
        rows = rows.sort_values(["source_task", "offset"], kind="stable")
        pieces = [(None if pd.isna(d) else int(d), int(s), np.frombuffer(i, dtype="<u4"), int(t))
                  for d, s, i, t in zip(rows["doc_id"], rows["start"], rows["ids"], rows["doc_tokens"], strict=True)]
        full, rest = merge([pieces], length)
        if last and rest:
            full, rest = [*full, rest], []
        done = _rows(full, [_sequence_id(round_, group, k) for k in range(len(full))], group)
        return pd.concat([done, _rows([rest], [None], group)]) if rest else done
    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = LENGTH, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """Pack every document; one row per piece: doc_id, start (ids of its document before it), length, ids
    (little-endian unsigned 32-bit), doc_tokens (with the end id), sequence_id, offset, sequence_tokens (ids in the
    sequence), padded_tokens (``length``, or the ids themselves at a power of two).

    A document is its token ids, then ``end_id``; null or empty text is the end id alone. Rows that repeat, or share an
    id, are packed each; a null doc_id is carried as it is. Other columns are not read. An empty table gives no pieces.
    """
    small_batches(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInPandas(_pack_task(tokenizer, end_id, length, open_windows), SCHEMA)
    table = written(rows, "pieces")
    finished, left = [table.where("sequence_id IS NOT NULL")], table.where("sequence_id IS NULL")
    tasks, round_ = (left.agg(F.max("source_task")).first()[0] or 0) + 1, 1
    while True:
        last = tasks <= FAN_IN
        merged = left.groupBy(F.expr(f"source_task div {FAN_IN}").alias("merge_group")) \
            .applyInPandas(_merge_group(round_, length, last), SCHEMA)
        if last:
            finished.append(merged)
            break
        merged = written(merged, f"pieces-round{round_}")
        finished.append(merged.where("sequence_id IS NOT NULL"))
        left, tasks, round_ = merged.where("sequence_id IS NULL"), -(-tasks // FAN_IN), round_ + 1
    out = finished[0]
    for f in finished[1:]:
        out = out.unionByName(f)
    power = F.col("sequence_tokens").bitwiseAND(F.col("sequence_tokens") - 1) == 0
    return out.drop("source_task").withColumn("padded_tokens", F.when(power, F.col("sequence_tokens")).otherwise(F.lit(length)))
