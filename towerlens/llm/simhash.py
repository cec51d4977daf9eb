"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints: per bit, the majority of the XXH64 hashes of all word shingles.
Two fingerprints within ``RADIUS`` = 2 bits agree on two of four 16-bit blocks,
so every distinct fingerprint goes to the six buckets of its block pairs. In a
bucket the members' bits are stored vertically (one plane of 64 members a word
for each bit); a query's distances to 64 members are updated at once by
carry-save counters, and a word is abandoned as soon as all its members exceed
the radius. A bucket leaves a spanning forest of its links, and the links of
all buckets are joined to components.

Scale: copies are folded to one fingerprint first. Of a bucket with more than
``BUCKET`` members the free bits are cut in three, one of which must agree
too; after two such cuts at most 2^14 distinct members can share a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.llm.common import fresh, small_batches, written
from towerlens.llm.components import components

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Members beyond which a bucket is cut further.
BUCKET = 1024
#: (Query, word) pairs that are compared at once.
PAIRS = 50_000

_BITS = np.arange(64, dtype=np.uint64)
_ONE = np.uint64(1)


def fingerprint(text, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a whole text (null or no words: 0)."""
    words = (text if isinstance(text, str) else "").encode("utf-8", "surrogatepass").lower().split()  # A-Z; ASCII white space
    if not words:
        return 0
    line = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    ends = starts[min(shingle, len(words)):]
    xxh = xxhash.xxh64_intdigest
    hashes = np.array([xxh(line[s:e - 1], SEED) for s, e in zip(starts, ends, strict=False)], dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(((2 * counts > n).astype(np.uint64) << _BITS).sum())


def _fingerprint_udf(shingle: int):
    @F.pandas_udf(T.LongType())
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))
    return simhash


def _masks(radius: int = RADIUS) -> list[list[int]]:
    """Bit masks whose values must agree, by level: the pairs of four blocks, then each with a third of its free bits, twice."""
    block = [0xFFFF << (16 * i) for i in range(4)]
    levels = [[block[i] | block[j] for i in range(4) for j in range(i + 1, 4)]]
    for _ in range(2):
        finer = []
        for mask in levels[-1]:
            free = [b for b in range(64) if not mask >> b & 1]
            finer += [mask | sum(1 << b for b in free[k::radius + 1]) for k in range(radius + 1)]
        levels.append(finer)
    return levels


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def slice_planes(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(planes, valid): planes[j, w] holds bit j of members 64w to 64w+63; valid marks the places that have a member."""
    words = -(-len(prints) // 64)
    padded = np.zeros(words * 64, dtype=np.uint64)
    padded[:len(prints)] = prints
    planes = np.zeros((64, words), dtype=np.uint64)
    for j in range(64):
        bits = ((padded >> np.uint64(j)) & _ONE).astype(np.uint8)
        planes[j] = np.packbits(bits, bitorder="little").view("<u8")
    valid = np.zeros(words * 64, dtype=np.uint8)
    valid[:len(prints)] = 1
    return planes, np.packbits(valid, bitorder="little").view("<u8").astype(np.uint64)


def within(planes: np.ndarray, valid: np.ndarray, queries: np.ndarray, words: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For pairs (query print, word of members): indices of pairs with members within the radius, and those members as bits."""
    alive = np.arange(len(queries))
    depth = (radius + 1).bit_length()
    counters = [np.zeros(len(queries), dtype=np.uint64) for _ in range(depth)]
    beyond = ~valid[words]  # empty places never match; a count that passes the radius stays beyond
    for j in range(64):
        carry = planes[j][words] ^ (np.uint64(0) - ((queries >> np.uint64(j)) & _ONE))
        for c in range(depth):
            counters[c], carry = counters[c] ^ carry, counters[c] & carry
        equal = ~(np.zeros_like(beyond))
        for c in range(depth):  # counter == radius + 1
            equal &= counters[c] if (radius + 1) >> c & 1 else ~counters[c]
        beyond |= equal
        if j % 4 == 3:
            stay = np.flatnonzero(~beyond)
            if len(stay) < len(beyond):
                alive, queries, words, beyond = alive[stay], queries[stay], words[stay], beyond[stay]
                counters = [x[stay] for x in counters]
            if not len(alive):
                break
    return alive, ~beyond


def roots_of(n: int, i: np.ndarray, j: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Smallest member reachable through the links (i, j), for each of n members; ``label`` carries earlier links."""
    label = np.arange(n) if label is None else label
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while not np.array_equal(label, label[label]):
            label = label[label]


def links_in(prints: np.ndarray, group: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Root index of every member; ``group`` (ascending) says which members share a bucket. Links never cross buckets."""
    n = len(prints)
    first = np.flatnonzero(np.diff(group, prepend=group[0] - 1 if n else 0))
    sizes = np.diff(np.append(first, n))
    words = -(-sizes // 64)  # every bucket starts on a word of its own
    word_start = np.concatenate([[0], np.cumsum(words)])[:-1]
    place = np.arange(n) - np.repeat(first, sizes) + np.repeat(word_start * 64, sizes)
    member = np.full(int(words.sum()) * 64, -1, dtype=np.int64)
    member[place] = np.arange(n)
    laid = np.where(member >= 0, prints[np.maximum(member, 0)], np.uint64(0))
    planes, _ = slice_planes(laid)
    valid = np.packbits((member >= 0).astype(np.uint8), bitorder="little").view("<u8").astype(np.uint64)
    label = np.arange(n)
    several = np.repeat(sizes > 1, sizes)
    queries = np.flatnonzero(several)
    q_words, q_first = np.repeat(words, sizes)[queries], np.repeat(word_start, sizes)[queries]
    at = 0
    ends = np.cumsum(q_words)
    while at < len(queries):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
        count = q_words[at:stop]
        q = np.repeat(queries[at:stop], count)
        offset = np.arange(len(q)) - np.repeat(np.cumsum(count) - count, count)
        w = np.repeat(q_first[at:stop], count) + offset
        alive, bits = within(planes, valid, prints[q], w, radius)
        flat = np.unpackbits(bits.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        pair, lane = np.nonzero(flat)
        label = roots_of(n, q[alive[pair]], member[w[alive[pair]] * 64 + lane], label)
        at = stop
    return label


def _bucket_links(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by bucket; whole buckets are compared as soon as they are complete."""
        held: list[pd.DataFrame] = []
        rows = 0

        def compare(part: pd.DataFrame) -> pd.DataFrame:
            change = (part["mask"].to_numpy()[1:] != part["mask"].to_numpy()[:-1]) | (part["key"].to_numpy()[1:] != part["key"].to_numpy()[:-1])
            group = np.concatenate([[0], np.cumsum(change)])
            prints = part["fp"].to_numpy()
            root = links_in(prints.view(np.uint64), group, radius)
            moved = np.flatnonzero(root != np.arange(len(root)))
            return pd.DataFrame({"a": prints[moved], "b": prints[root[moved]]})

        for b in batches:
            held.append(b)
            rows += len(b)
            if rows < 50_000:
                continue
            part = pd.concat(held, ignore_index=True)
            last = part.iloc[-1]
            open_ = int(((part["mask"] == last["mask"]) & (part["key"] == last["key"])).to_numpy()[::-1].argmin()) or len(part)
            if open_ < len(part):
                yield compare(part.iloc[:-open_])
            held, rows = [part.iloc[-open_:]], open_
        if rows:
            yield compare(pd.concat(held, ignore_index=True))
    return run


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect what lies within ``radius`` (2 at most) bits, of distinct prints ``fp`` (long)."""
    if not 0 <= radius <= RADIUS:
        raise ValueError("the bucket masks hold for 2 differing bits at most")
    spark = prints.sparkSession
    levels = [[_signed(m) for m in level] for level in _masks()]

    def keyed(df: DataFrame, masks: list[int]) -> DataFrame:
        rows = df.withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
        return rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    found = None
    level = keyed(prints.select("fp"), levels[0])
    for depth in range(len(levels)):
        sizes = level.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        if depth < len(levels) - 1:
            sizes = written(sizes.where(f"members > {BUCKET}"), "large-buckets")
            whole = level.join(sizes.select("mask", "key"), ["mask", "key"], "left_anti")
        else:
            whole = level
        rows = whole.repartition(parts, "mask", "key").sortWithinPartitions("mask", "key", "fp").select("fp", "mask", "key")
        now = rows.mapInPandas(_bucket_links(radius), "a long, b long")
        found = now if found is None else found.union(now)
        if depth == len(levels) - 1 or sizes.isEmpty():
            break
        large = level.join(sizes.select("mask", "key"), ["mask", "key"], "left_semi")
        finer = {m: levels[depth + 1][3 * k:3 * k + 3] for k, m in enumerate(levels[depth])}
        table = spark.createDataFrame([(m, f) for m, fs in finer.items() for f in fs], "mask long, finer long")
        level = large.join(F.broadcast(table), "mask").select("fp", F.col("finer").alias("mask"), F.col("fp").bitwiseAND(F.col("finer")).alias("key"))
    return found


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fp (fingerprint as a long), component_id.

    Documents whose fingerprints differ in at most ``radius`` bits are linked;
    component_id is the smallest doc_id reachable. Null and empty texts, and
    texts without words, have fingerprint 0 and are linked like any other.
    Rows that repeat get the same row each; null doc_ids are reported but never
    name a component that has an id. An empty table gives an empty result; no
    other column is read.
    """
    small_batches(docs)
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), _fingerprint_udf(shingle)("text").alias("fp")), "fingerprints")
    return rows.join(component_of(rows, radius), "fp").select("doc_id", "fp", "component_id")


def component_of(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint in ``rows`` (doc_id, fp); components have one root each."""
    prints = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-prints")
    roots = components(links(prints, radius), "simhash")
    named = prints.join(roots, prints["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(least, "root").select("fp", "root", "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest doc_id; all columns as they are.

    Of rows of a component that share that id one stays; so does one row of a component that has null ids only.
    """
    small_batches(docs)
    simhash = _fingerprint_udf(shingle)
    prints = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), simhash("text").alias("fp")), "fingerprints")
    own = prints.join(component_of(prints, radius), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    heads = own.groupBy("root").agg(F.min("fp").alias("head_fp"), F.min("component_id").alias("head_id"))
    fp = fresh("fp_", docs.columns)
    rows = docs.withColumn(fp, simhash("text"))
    stay = rows.join(heads, (rows[fp] == heads["head_fp"]) & rows["doc_id"].cast("long").eqNullSafe(heads["head_id"]), "left_semi")
    return stay.dropDuplicates([fp]).drop(fp)
