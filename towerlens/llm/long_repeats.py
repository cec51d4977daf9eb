"""Long repeats across documents, by run-length indexes of what repeats.

A byte is removed when a ``LENGTH``-byte string that covers it also starts in a
document of smaller id. All such strings are found exactly:

1. Anchors. Of every ``LENGTH`` bytes the ``K``-byte string of smallest hash is
   an anchor, so equal strings hold equal anchors. Anchor hashes of all
   documents meet by hash; only those of several documents go on.
2. Contexts. An anchor's context is all strings of ``LENGTH`` bytes that hold it.
   Hashes of contexts meet by anchor, each with the smallest id of its bucket:
   a context that a smaller id holds elsewhere is a copy as a whole.
3. Index. Of an anchor with several different contexts, each is sent once, by the
   bucket of its smallest id, to one partition. That builds a run-length index
   (run-compressed BWT, sampled run ends) of them, streams match lengths from
   the samples, and marks what a context shares with one of a smaller id.
4. Marks return to the documents, whose covered bytes go.

Scale: documents are dealt to buckets by their id once, and that exchange
serves all steps; hashes, contexts and marks move packed, per bucket and
partition. An anchor with more than ``HOT`` different contexts (a line or
passage that much of the corpus holds) does not meet as a whole: its single
strings of ``LENGTH`` bytes are dealt by their own hash instead, each told once
a bucket. Nothing is capped, and no pair of documents is formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens.llm.common import mix64, sliding_min, small_batches
from towerlens.llm.run_index import RunLengthIndex
from towerlens.llm.winnowing import _BASE, _INVERSE, _power

LENGTH = 50
K = 24
REACH = LENGTH - K  # bytes of context on each side of an anchor
#: Contexts of one anchor beyond which its strings are dealt singly.
HOT = 2048
#: A bucket tells of at most this many contexts of an anchor in step 1, enough to see that it is hot.
TOLD = 64
#: Text bytes planned for a bucket, and for a partition of anchors.
BUCKET_BYTES, PART_BYTES = 8 << 20, 24 << 20
#: Bytes of one run-length index.
INDEX_BYTES = 2 << 20
#: Bytes hashed at once, so that the arrays of a step stay in a processor cache.
SEGMENT = 1 << 17
MARGIN = 128
NO_ID = np.iinfo(np.int64).max  # a null id is larger than any other

_U = np.uint64
_FLAG = _U(1)


class _Segment:
    """Prefix sums over part of a bucket's bytes, for the hash of any string inside."""

    def __init__(self, raw: np.ndarray, first: int, last: int):
        self.first = first
        part = raw[first:last]
        self.sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + _U(1)) * _power(_BASE, len(part)), out=self.sums[1:])
        self.back = _power(_INVERSE, len(part) + 1)

    def hash(self, a: np.ndarray, b: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """Hash of raw[a:b]; strings of different salt (or length) differ."""
        with np.errstate(over="ignore"):
            h = (self.sums[b - self.first] - self.sums[a - self.first]) * self.back[a - self.first]
            return mix64(mix64(h) + (b - a).astype(np.uint64) * _U(0x9E3779B97F4A7C15) + salt.astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F))


class _Bucket:
    """The documents of a bucket as one run of bytes, ordered by id and text: the same in every step, however they come."""

    def __init__(self, docs: pd.DataFrame):
        ids = docs["doc_id"].astype("Int64").fillna(NO_ID).to_numpy(dtype=np.int64)
        null = docs["doc_id"].isna().to_numpy()
        texts = [(t if isinstance(t, str) else "").encode("utf-8", "surrogatepass") for t in docs["text"]]
        order = sorted(range(len(texts)), key=lambda i: (ids[i], null[i], texts[i]))
        texts, ids, self.null = [texts[i] for i in order], ids[order], null[order]
        self.ids = ids
        self.ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.starts = self.ends - np.array([len(t) for t in texts], dtype=np.int64)
        self.bytes = b"".join(texts)
        self.raw = np.frombuffer(self.bytes, dtype=np.uint8)

    def anchors(self, wanted: np.ndarray | None = None) -> Iterator[tuple]:
        """Per segment: (segment, document, context start, context end, anchor hash with a free low bit, context hash);
        of the anchors whose hash is among the sorted ``wanted``, if given."""
        n = len(self.raw)
        for core in range(0, n, SEGMENT):
            first, last = max(0, core - MARGIN), min(n, core + SEGMENT + MARGIN)
            part = self.raw[first:last]
            if len(part) < LENGTH:
                continue
            words = np.ndarray((len(part) - 7,), dtype="<u8", buffer=part.tobytes(), strides=(1,)).astype(np.uint64)
            with np.errstate(over="ignore"):
                h = words[K - 8:]
                for at in range(K - 16, -1, -8):
                    h = mix64(h) + words[at:at + len(h)] * _U(0x9E3779B97F4A7C15)
                h = mix64(h) & ~_FLAG
            low = sliding_min(h, REACH + 1)
            pad = np.zeros(REACH, dtype=np.uint64)
            at = np.flatnonzero(~sliding_min(~np.concatenate([pad, low, pad]), REACH + 1) == h)
            at = at[(at + first >= core) & (at + first < core + SEGMENT)]
            h, at = h[at], at + first
            if wanted is not None:
                own, _ = _lookup(wanted, h)
                if not len(own):
                    continue
                h, at = h[own], at[own]
            doc = np.searchsorted(self.ends, at, side="right")
            a, b = np.maximum(at - REACH, self.starts[doc]), np.minimum(at + K + REACH, self.ends[doc])
            inside = (at + K <= self.ends[doc]) & (b - a >= LENGTH)  # too short a context holds no string
            at, doc, a, b, h = at[inside], doc[inside], a[inside], b[inside], h[inside]
            segment = _Segment(self.raw, first, last)
            yield segment, doc, a, b, h, segment.hash(a, b, at - a + 1)


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> _U(24)) % _U(parts)).astype(np.int64)


def _packed(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(partition, indices) for every partition that occurs."""
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for own in np.split(order, cuts):
        if len(own):
            yield int(part[own[0]]), own


def _unique_min(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first row of the smallest id for every distinct key, and the rows in that order per key."""
    order = np.lexsort((ids, keys))
    sorted_ = keys[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return order[first], order


def _tell_anchors(parts: int):
    """Step 1: the anchor hashes of a bucket, once per different context (at most TOLD times), low bit: several documents."""
    def run(key: tuple[Any, ...], docs: pd.DataFrame) -> pd.DataFrame:
        bucket = _Bucket(docs)
        hashes, contexts, owners = [], [], []
        for _, doc, _, _, h, context in bucket.anchors():
            hashes.append(h)
            contexts.append(context)
            owners.append(bucket.ids[doc])
        if not hashes:
            return pd.DataFrame({"part": [], "bucket": [], "hashes": []})
        h, c, o = np.concatenate(hashes), np.concatenate(contexts), np.concatenate(owners)
        order = np.lexsort((o, h))
        h, c, o = h[order], c[order], o[order]
        first = np.concatenate([[True], h[1:] != h[:-1]])
        group = np.cumsum(first) - 1
        several = np.zeros(int(group[-1]) + 1, dtype=bool)
        np.logical_or.at(several, group[1:], ~first[1:] & (o[1:] != o[:-1]))
        _, one = np.unique(c, return_index=True)  # one row per different context
        one.sort()
        group = group[one]
        nth = np.arange(len(one)) - np.searchsorted(group, group)
        one, group = one[nth < TOLD], group[nth < TOLD]
        value = h[one] | several[group].astype(np.uint64)
        rows = [(p, int(key[0]), np.sort(value[own]).astype("<u8").tobytes()) for p, own in _packed(_part(h[one], parts))]
        return pd.DataFrame(rows, columns=["part", "bucket", "hashes"])
    return run


def _repeated_anchors(most: int):
    """Of a partition of hashes, those that several documents hold, back to each bucket; low bit: hot, that is told more
    than ``most`` times, or as often as one bucket tells."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        values = [np.frombuffer(x, dtype="<u8").astype(np.uint64) for x in rows["hashes"]]
        every = np.concatenate(values)
        source = np.repeat(np.arange(len(values)), [len(v) for v in values])
        key = every & ~_FLAG
        order = np.argsort(key, kind="stable")
        key, source, told = key[order], source[order], (every & _FLAG)[order]  # sources ascend within a key
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first = np.flatnonzero(new)
        by_source = np.flatnonzero(new | np.concatenate([[True], source[1:] != source[:-1]]))
        fullest = np.maximum.reduceat(np.diff(np.append(by_source, len(key))), np.searchsorted(by_source, first))
        hot = (np.diff(np.append(first, len(key))) > most) | (fullest >= TOLD)
        keep = (np.minimum.reduceat(source, first) != np.maximum.reduceat(source, first)) | (np.maximum.reduceat(told, first) > 0)
        answer = (key[first] | hot.astype(np.uint64))[keep]
        out = []
        for bucket, own in zip(rows["bucket"], values, strict=True):
            hit, at = _lookup(answer & ~_FLAG, np.unique(own & ~_FLAG))
            if len(hit):
                out.append((int(bucket), answer[at].astype("<u8").tobytes()))
        return pd.DataFrame(out, columns=["bucket", "hashes"])
    return run


def _lookup(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indices of ``keys`` that are among the sorted ones, and where)."""
    at = np.searchsorted(sorted_keys, keys)
    hit = np.flatnonzero(at < len(sorted_keys))
    hit = hit[sorted_keys[at[hit]] == keys[hit]]
    return hit, at[hit]


def _windows(segment: _Segment, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every string of LENGTH bytes in [a, b): (row, start, hash)."""
    n = b - a - LENGTH + 1
    row = np.repeat(np.arange(len(a)), n)
    start = a[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return row, start, segment.hash(start, start + LENGTH, np.zeros(len(start), dtype=np.int64))


def _packed_hashes(rows: pd.DataFrame, column: str) -> np.ndarray:
    found = [np.frombuffer(x, dtype="<u8") for x in rows[column] if x is not None]
    return np.sort(np.concatenate(found).astype(np.uint64)) if found else np.zeros(0, dtype=np.uint64)


class _Repeats:
    """All contexts of repeated anchors in a bucket (of hot anchors their single strings), and the distinct ones by key."""

    def __init__(self, bucket: _Bucket, answer: np.ndarray):
        none = np.zeros(0, dtype=np.int64)
        found: list[tuple] = [(none.astype(np.uint64), none.astype(np.uint64), none, none, none)]
        wanted = answer & ~_FLAG
        for segment, doc, a, b, h, context in bucket.anchors(wanted) if len(answer) else ():
            hot = (answer[np.searchsorted(wanted, h)] & _FLAG) > 0
            plain = np.flatnonzero(~hot)
            found.append((h[plain], context[plain], bucket.ids[doc[plain]], a[plain], b[plain]))
            if hot.any():
                own = np.flatnonzero(hot)
                row, start, string = _windows(segment, a[own], b[own])
                found.append((string, string, bucket.ids[doc[own]][row], start, start + LENGTH))
        self.anchors, self.keys, self.ids, self.a, self.b = (np.concatenate(x) for x in zip(*found, strict=True))
        self.one, order = _unique_min(self.keys, self.ids)
        self.context = np.empty(len(order), dtype=np.int64)  # of every occurrence: its place among the distinct ones
        if len(order):
            ranked = self.keys[order]
            self.context[order] = np.cumsum(np.concatenate([[0], (ranked[1:] != ranked[:-1]).astype(np.int64)]))

    def by_part(self, parts: int) -> Iterator[tuple[int, np.ndarray]]:
        """(partition, places of its distinct contexts), always in the same order."""
        return _packed(_part(self.anchors[self.one], parts))


_CONTEXTS = "part int, bucket int, anchors binary, keys binary, owners binary, sizes binary, text binary"
_ANSWERS = "bucket int, part int, hashes binary, bits binary, keys binary, masks binary"


def _answers(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["bucket", "part", "hashes", "bits", "keys", "masks"])


def _tell_contexts(parts: int):
    """Step 2: hashes of the different contexts of a bucket, each with its smallest id."""
    def run(key: tuple[Any, ...], docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(docs):
            r = _Repeats(_Bucket(docs), _packed_hashes(told, "hashes"))
            for p, own in r.by_part(parts):
                own = r.one[own]
                out.append((p, int(key[0]), (r.anchors[own] >> _U(20)).astype("<u4").tobytes(), r.keys[own].astype("<u8").tobytes(),
                            r.ids[own].astype("<i8").tobytes(), None, None))
        return pd.DataFrame(out, columns=["part", "bucket", "anchors", "keys", "owners", "sizes", "text"])
    return run


def _compare(rows: pd.DataFrame) -> pd.DataFrame:
    """For each bucket: which of its contexts a smaller id holds elsewhere (bits, in its order), and the keys of those it
    should send: it holds their smallest id, and their anchor has other contexts."""
    anchors, keys, owners = (np.concatenate([np.frombuffer(x, dtype=kind) for x in rows[c]])
                             for c, kind in (("anchors", "<u4"), ("keys", "<u8"), ("owners", "<i8")))
    sizes = np.array([len(x) // 8 for x in rows["keys"]])
    source = np.repeat(np.arange(len(sizes)), sizes)
    one, order = _unique_min(keys, owners)
    ranked = keys[order]
    context = np.empty(len(keys), dtype=np.int64)
    context[order] = np.cumsum(np.concatenate([[0], (ranked[1:] != ranked[:-1]).astype(np.int64)]))
    elsewhere = owners[one][context] < owners
    _, which, members = np.unique(anchors[one], return_inverse=True, return_counts=True)
    wanted = one[members[which] > 1]
    wanted = wanted[np.argsort(source[wanted], kind="stable")]
    at = np.searchsorted(source[wanted], np.arange(len(sizes) + 1))
    ends = np.cumsum(sizes)
    return _answers([{"bucket": int(bucket), "part": int(part), "bits": np.packbits(elsewhere[end - n:end]).tobytes(),
                      "keys": keys[wanted[at[i]:at[i + 1]]].astype("<u8").tobytes()}
                     for i, (bucket, part, n, end) in enumerate(zip(rows["bucket"], rows["part"], sizes, ends, strict=True))])


def _send_contexts(parts: int):
    """The wanted contexts of a bucket, with their bytes."""
    def run(key: tuple[Any, ...], docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        out = []
        wanted = _packed_hashes(told, "keys")
        if len(docs) and len(wanted):
            bucket = _Bucket(docs)
            r = _Repeats(bucket, _packed_hashes(told, "hashes"))
            for p, own in r.by_part(parts):
                own = r.one[own]
                own = own[_lookup(wanted, r.keys[own])[0]]
                if len(own):
                    text = b"".join(bucket.bytes[i:j] for i, j in zip(r.a[own], r.b[own], strict=True))
                    out.append((p, int(key[0]), (r.anchors[own] >> _U(20)).astype("<u4").tobytes(), r.keys[own].astype("<u8").tobytes(),
                                r.ids[own].astype("<i8").tobytes(), (r.b - r.a)[own].astype(np.uint8).tobytes(), text))
        return pd.DataFrame(out, columns=["part", "bucket", "anchors", "keys", "owners", "sizes", "text"])
    return run


def _judge(rows: pd.DataFrame) -> pd.DataFrame:
    """Step 3: which strings of a context a context of a smaller id holds (bit o: from its byte o)."""
    anchors, keys, owner, sizes = (np.concatenate([np.frombuffer(x, dtype=kind) for x in rows[c]])
                                   for c, kind in (("anchors", "<u4"), ("keys", "<u8"), ("owners", "<i8"), ("sizes", np.uint8)))
    source = np.repeat(np.arange(len(rows)), [len(x) for x in rows["sizes"]])
    ends = np.cumsum(sizes, dtype=np.int64)
    text = b"".join(rows["text"])
    masks = np.zeros(len(keys), dtype=np.uint64)
    # Indexes of about INDEX_BYTES; an anchor's contexts stay together.
    order = np.argsort(anchors, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], anchors[order][1:] != anchors[order][:-1]]))
    batch = np.cumsum(sizes[order] + 1, dtype=np.int64)[heads] // INDEX_BYTES
    for part in np.split(order, heads[1:][batch[1:] != batch[:-1]]):
        texts = [text[ends[i] - sizes[i]:ends[i]].replace(b"\x00", b"\xff") for i in part]  # 255 is in no UTF-8 text
        index = RunLengthIndex(texts)
        low = index.smallest_owner(owner[part], LENGTH)
        place = np.flatnonzero((low >= 0) & (low < owner[part][index.text_of]))
        start = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])[index.text_of[place]]
        np.bitwise_or.at(masks, part[index.text_of[place]], _U(1) << (place - start).astype(np.uint64))
    out = []
    for n, bucket in enumerate(rows["bucket"]):
        own = np.flatnonzero((source == n) & (masks > 0))
        if len(own):
            out.append({"bucket": int(bucket), "keys": keys[own].astype("<u8").tobytes(), "masks": masks[own].astype("<u8").tobytes()})
    return _answers(out)


def _remove(parts: int):
    """Step 4: mark and cut the documents of a bucket."""
    def run(key: tuple[Any, ...], docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        bucket = _Bucket(docs)
        r = _Repeats(bucket, _packed_hashes(told, "hashes"))
        bits = {p: b for p, b in zip(told["part"], told["bits"], strict=True) if b is not None}
        elsewhere = np.zeros(len(r.one), dtype=bool)
        for p, own in r.by_part(parts):
            elsewhere[own] = np.unpackbits(np.frombuffer(bits[p], dtype=np.uint8))[:len(own)].astype(bool)
        copy = elsewhere[r.context] | (r.ids > r.ids[r.one][r.context])
        begin, end = [r.a[copy]], [r.b[copy]]
        judged = told[[m is not None for m in told["masks"]]]
        if len(judged):
            keys, masks = (np.concatenate([np.frombuffer(x, dtype="<u8") for x in judged[c]]).astype(np.uint64) for c in ("keys", "masks"))
            order = np.argsort(keys)
            own, at = _lookup(keys[order], np.where(copy, _U(0), r.keys))
            own, at = own[~copy[own]], at[~copy[own]]
            start, strings = r.a[own], masks[order][at]
            for o in range(REACH + 1):
                on = start[(strings >> _U(o)) & _FLAG > 0] + o
                begin.append(on)
                end.append(on + LENGTH)
        edge = np.bincount(np.concatenate(begin), minlength=len(bucket.raw) + 1)
        edge -= np.bincount(np.concatenate(end), minlength=len(bucket.raw) + 1)
        gone = np.cumsum(edge[:-1], out=edge[:-1]) > 0
        out = []
        for n, (s, e) in enumerate(zip(bucket.starts, bucket.ends, strict=True)):
            flags = gone[s:e]
            change = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
            starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
            kept = bucket.bytes[s:e] if not len(starts) else bucket.raw[s:e][~flags].tobytes()
            out.append((None if bucket.null[n] else int(bucket.ids[n]), int(e - s), starts.tolist(), ends.tolist(), kept))
        return pd.DataFrame(out, columns=["doc_id", "n_bytes", "starts", "ends", "kept"]).astype({"doc_id": "Int64"})
    return run


def remove_long_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, starts and ends (byte offsets of the maximal removed runs), kept (the
    remaining bytes).

    Texts are taken as UTF-8 bytes, null as empty. Documents that share an id do not remove from each other; a null id
    is larger than any other, so such a document loses what any other holds and removes nothing. Repeated rows are
    treated alike. A text under 50 bytes is never touched. An empty table gives an empty result; other columns are not
    read.
    """
    spark = docs.sparkSession
    small_batches(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(shuffle, -(-total // BUCKET_BYTES))
    parts = max(shuffle, -(-total // PART_BYTES))
    dealt = rows.select(F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int").alias("bucket"), "doc_id", "text")
    hashes = dealt.groupBy("bucket").applyInPandas(_tell_anchors(parts), "part int, bucket int, hashes binary")
    repeated = hashes.groupBy("part").applyInPandas(_repeated_anchors(hot), "bucket int, hashes binary")
    told = dealt.groupBy("bucket").cogroup(repeated.groupBy("bucket")).applyInPandas(_tell_contexts(parts), _CONTEXTS)
    compared = told.select("part", "bucket", "anchors", "keys", "owners").groupBy("part").applyInPandas(_compare, _ANSWERS)
    empty = [F.lit(None).cast("binary").alias(c) for c in ("bits", "keys", "masks")]
    answers = repeated.select("bucket", F.lit(None).cast("int").alias("part"), "hashes", *empty).unionByName(compared)
    sent = dealt.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInPandas(_send_contexts(parts), _CONTEXTS)
    judged = sent.groupBy("part").applyInPandas(_judge, _ANSWERS)
    # Keys of step 2 asked for contexts; those of step 3 go with their masks.
    marks = answers.withColumn("keys", F.lit(None).cast("binary")).unionByName(judged)
    return dealt.groupBy("bucket").cogroup(marks.groupBy("bucket")).applyInPandas(
        _remove(parts), "doc_id long, n_bytes long, starts array<int>, ends array<int>, kept binary")
