"""Benchmark decontamination by winnowing.

Both sides are cut into words; of every ``WINDOW - K + 1`` consecutive hashes
of ``K`` words the smallest is kept as a fingerprint. Two texts that share
``WINDOW`` words in a row share the fingerprint picked inside them, so joining
document fingerprints with benchmark fingerprints finds every shared window;
each join hit is then extended: the windows of the document around it are
compared with the benchmark's by their words. Items of fewer than ``WINDOW``
words are one window each, too short for the guarantee; their hash is looked
up at every position.

Scale: the benchmark is the stated query set. Its items are read in blocks of
at most ``BLOCK_BYTES`` of words, a bound that is checked while they are read;
each block is broadcast and joined with all documents where they lie. No
document is shuffled, a document of any length is hashed in segments.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.llm.common import fresh, mix64, sliding_min, small_batches, written

WINDOW = 10
K = 5
#: Bytes of benchmark words broadcast at once (tasks hold about ten times this).
BLOCK_BYTES = 8 << 20
#: Bytes hashed at once, and texts of a batch that are taken together.
SEGMENT = 1 << 20

#: Words are runs of 0-9, a-z and everything from U+0080 up; A-Z is lowered, all else separates.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if len(_POWERS.get(base, ())) < n:
        _POWERS[base] = _powers(base, max(n, SEGMENT + 1))
    return _POWERS[base][:n]


def normalise(text) -> bytes:
    """Lowered words with separators as spaces; null is empty."""
    return (text if isinstance(text, str) else "").encode("utf-8", "surrogatepass").translate(_TABLE)


def _segments(raw: bytes) -> Iterator[tuple[int, bytes]]:
    """Cut at spaces into parts of about SEGMENT bytes."""
    at = 0
    while at < len(raw):
        end = at + SEGMENT
        if end < len(raw):
            end = raw.find(b" ", end)
            end = len(raw) if end < 0 else end
        yield at, raw[at:end]
        at = end


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every word: a polynomial over its bytes from prefix sums modulo 2^64, then mixed."""
    found = []
    with np.errstate(over="ignore"):
        for at, part in _segments(raw):
            a = np.frombuffer(part, dtype=np.uint8)
            inside = np.zeros(len(a) + 2, dtype=np.int8)
            inside[1:-1] = a != 32
            edge = np.diff(inside)
            starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            if not len(starts):
                continue
            sums = np.zeros(len(a) + 1, dtype=np.uint64)
            np.cumsum(a * _power(_BASE, len(a)), out=sums[1:])
            h = (sums[ends] - sums[starts]) * _power(_INVERSE, len(a))[starts]
            found.append((mix64(h + (ends - starts).astype(np.uint64)), starts + at, ends + at))
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(len(words) - n + 1, dtype=np.uint64)
        for j in range(n):
            h = h * np.uint64(_BASE) + words[j:len(words) - n + 1 + j]
    return mix64(h)


def winnow(hashes: np.ndarray, width: int = WINDOW - K + 1) -> np.ndarray:
    """Positions whose hash is the smallest of some ``width`` consecutive ones (of all, if there are fewer)."""
    if len(hashes) <= width:
        return np.flatnonzero(hashes == hashes.min()) if len(hashes) else np.zeros(0, dtype=np.int64)
    low = sliding_min(hashes, width)
    pad = np.zeros(width - 1, dtype=np.uint64)
    highest = ~sliding_min(~np.concatenate([pad, low, pad]), width)  # sliding maximum of the window minima
    return np.flatnonzero(highest == hashes)


class Block:
    """Part of a benchmark: fingerprints of its long items, and all windows with the items that hold them."""

    def __init__(self, items: list[tuple[str, bytes]]):
        self.windows: dict[bytes, list[int]] = defaultdict(list)
        self.names = [name for name, _ in items]
        prints, short = [], defaultdict(list)
        for n, (_, raw) in enumerate(items):
            words = raw.split()
            size = min(WINDOW, len(words))
            for i in range(len(words) - size + 1 if words else 0):
                window = b" ".join(words[i:i + size])
                if not (seen := self.windows[window]) or seen[-1] != n:
                    seen.append(n)
            hashes = word_hashes(raw)[0]
            if len(words) >= WINDOW:
                grams = gram_hashes(hashes, K)
                prints.append(grams[winnow(grams)])
            elif words:
                short[len(words)].append(gram_hashes(hashes, len(words)))
        self.windows = dict(self.windows)
        self.prints = _Hashes(prints)
        self.short = {n: _Hashes(h) for n, h in short.items()}


class _Hashes:
    """A set of hashes; a table of marks turns most misses away before the search."""

    def __init__(self, parts: list[np.ndarray]):
        self.sorted = np.unique(np.concatenate(parts)) if parts else np.zeros(0, dtype=np.uint64)
        bits = max(10, min(24, int(len(self.sorted)).bit_length() + 5))
        self.mask = np.uint64((1 << bits) - 1)
        self.marks = np.zeros(1 << bits, dtype=bool)
        self.marks[(self.sorted & self.mask).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of the given hashes that are in the set."""
        if not len(self.sorted):
            return np.zeros(0, dtype=np.int64)
        maybe = np.flatnonzero(self.marks[(hashes & self.mask).astype(np.int64)])
        at = np.searchsorted(self.sorted, hashes[maybe])
        return maybe[self.sorted[np.minimum(at, len(self.sorted) - 1)] == hashes[maybe]]


def find(block: Block, texts) -> list[tuple[int, np.ndarray, list[str]]]:
    """For each text: its number of words, the positions of hit words, and the items with an occurring window."""
    raws = [normalise(t) for t in texts]
    joined = b" ".join(raws)
    ends = np.cumsum([len(r) + 1 for r in raws])
    hashes, starts, stops = word_hashes(joined)
    last = np.searchsorted(starts, ends)  # words of the texts up to each
    text_of = np.repeat(np.arange(len(raws)), np.diff(last, prepend=0))
    grams = gram_hashes(hashes, K)
    kept = winnow(grams)
    hit = np.zeros(len(hashes), dtype=bool)
    items: dict[int, set[int]] = defaultdict(set)

    def check(i: int, size: int) -> None:
        """Compare the window of ``size`` words from word i with the benchmark's."""
        if i < 0 or i + size > len(hashes) or text_of[i] != text_of[i + size - 1]:
            return
        window = b" ".join(joined[starts[j]:stops[j]] for j in range(i, i + size))
        if (found := block.windows.get(window)) is not None:
            hit[i:i + size] = True
            items[int(text_of[i])].update(found)

    around = {int(p) - j for p in kept[block.prints.hits(grams[kept])] for j in range(WINDOW - K + 1)}
    for i in around:
        check(i, WINDOW)
    for size, known in block.short.items():
        for i in known.hits(gram_hashes(hashes, size)):
            check(int(i), size)
    out, first = [], 0
    for n, end in enumerate(last):
        out.append((int(end - first), np.flatnonzero(hit[first:end]), [block.names[i] for i in items.get(n, ())]))
        first = end
    return out


def _parts(texts: pd.Series) -> Iterator[list]:
    now, held = [], 0
    for t in texts:
        now.append(t)
        held += len(t) if isinstance(t, str) else 0
        if held >= SEGMENT:
            yield now
            now, held = [], 0
    if now:
        yield now


_RESULT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("hit_words", T.ArrayType(T.IntegerType())),
                        T.StructField("items", T.ArrayType(T.StringType()))])


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, bytes]]]:
    """Items in blocks of at most BLOCK_BYTES (a longer item is a block of its own); the driver holds one at a time."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), "text").where("text IS NOT NULL")
    now: list[tuple[str, bytes]] = []
    held = 0
    for r in items.toLocalIterator():
        raw = normalise(r["text"])
        if now and held + len(raw) > BLOCK_BYTES:
            yield now
            now, held = [], 0
        now.append((r["name"], raw))
        held += len(raw)
    yield now  # an empty benchmark is one empty block


def contamination(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with one more column, and that column's name: a struct of n_words, hit_words (positions of the words
    inside a benchmark window, ascending) and items (ids, as text, of items with a window in the document, sorted).

    A null or empty text has no words. A null item text has no window, a null item_id is named by an empty text; items
    that share an id are one item. Rows that repeat are judged alike; with no items nothing is hit. Other columns stay
    as they are; the new column's name avoids theirs.
    """
    spark = docs.sparkSession
    small_batches(docs)
    column = fresh("contamination", docs.columns)
    out = docs
    blocks = 0
    for items in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(Block(items))

        @F.pandas_udf(_RESULT)
        def judge(texts: pd.Series) -> pd.DataFrame:
            rows = [r for part in _parts(texts) for r in find(shared.value, part)]
            return pd.DataFrame({"n_words": [r[0] for r in rows], "hit_words": [r[1].astype(np.int32) for r in rows],
                                 "items": [r[2] for r in rows]}, columns=["n_words", "hit_words", "items"])

        found = judge("text")
        if blocks:
            step = fresh("contamination_", out.columns)
            out = written(out.withColumn(step, found).withColumn(column, F.struct(
                F.col(f"{column}.n_words").alias("n_words"),
                F.array_union(f"{column}.hit_words", f"{step}.hit_words").alias("hit_words"),
                F.array_union(f"{column}.items", f"{step}.items").alias("items"))).drop(step), "contamination")
        else:
            out = out.withColumn(column, found)
        blocks += 1
    return out.withColumn(column, F.struct(
        F.col(f"{column}.n_words").alias("n_words"), F.array_sort(f"{column}.hit_words").alias("hit_words"),
        F.array_sort(F.array_distinct(f"{column}.items")).alias("items"))), column


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without documents that hold a benchmark window; all columns as they are."""
    judged, found = contamination(docs, benchmark)
    return judged.where(F.size(f"{found}.hit_words") == 0).drop(found)
