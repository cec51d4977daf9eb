"""Brown class-based n-gram scores of whole documents.

1. Chunks. A scan task numbers the words of each chunk of documents by a
   dictionary of its own and writes the number sequences and the dictionary;
   texts are read once and never shuffled.
2. Counts. The dictionaries of all chunks meet by word: its training count goes
   back to every chunk that holds it. Every word whose count reaches
   ``OWN_COUNT`` is clustered by itself; rare and unseen words belong to one of
   ``SHAPES`` units by the crc32 of their last four bytes.
3. Classes. Their number grows with the clustered words (``classes_for``). Exchange
   clustering of the ``OWN_UNITS`` most frequent words and the shapes gives the
   classes to start from. The pairs of successive words of all training documents
   are counted once, dealt by word, and written. Then come passes over all
   clustered words, which read that table without an exchange: the classes of a
   word's neighbours are counted, and each word (and shape) moves to the class
   whose neighbours explain its own best, until none moves or ``PASSES`` passes are
   done. A pass that
   lowers the likelihood of all training bigrams is undone and tried with a
   part of the words.
4. Scores. P(word | two before) = P(class | two classes before), Witten-Bell
   smoothed down to bigrams and unigrams, times P(word | class): the word's
   share of the class, less the class's mass of unseen words (its share of
   words seen once).

Scale: of what reaches the driver and is broadcast, one array grows with the
data: the class of each clustered word (two bytes a word). The rest is bounded
by parameters: unit bigrams (units squared), class trigrams (at most
``MAX_CLASSES`` + 1 cubed). Pairs stay dealt by word, ``PAIRS`` at most in a row;
counts of the parts of a larger bucket are added up by a shuffle. Counts cover all
training documents. A frequent word is one row per chunk.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from towerlens.llm.common import fold, shared_folder, small_batches, written
from towerlens.session import materialize, release

OWN_UNITS = 768
OWN_COUNT = 20
SHAPES = 256
CLASSES = 64
#: Bound of the number of classes, reached at two million clustered words.
MAX_CLASSES = 256
PASSES = 12
#: Clustered words, and shapes, whose neighbour counts a task holds at once; tokens' neighbours counted before they are
#: sent; and pairs of a bucket that are summed at once.
DEALT_WORDS = 4096
DEALT_SHAPES = 8
NEIGHBOURS = 4_000_000
PAIRS = 4_000_000
#: Tokens, and distinct words, after which a task starts the next chunk.
CHUNK_TOKENS = 4_000_000
CHUNK_WORDS = 500_000
#: Bytes of texts that are cut into words at once.
SEGMENT = 4 << 20

END = OWN_UNITS + SHAPES  # the unit of the end token
UNITS = END + 1
UNSEEN = 4096  # added to the unit of a word that training does not know (more if there are more units)

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of whole texts with A-Z lowered, one text after the other, and how many each text has."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(text))  # empty before leading and after trailing white space
    words = parts.flatten()
    full = pc.not_equal(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return words.filter(full), np.diff(before[np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy())])])


def _segments(text: pa.Array) -> Iterator[pa.Array]:
    """One text in parts of about SEGMENT bytes, cut before white space."""
    raw, at = text.cast(pa.binary())[0].as_py(), 0
    while at < len(raw):
        stop = len(raw) if at + SEGMENT >= len(raw) else (m.start() if (m := _SPACE.search(raw, at + SEGMENT)) else len(raw))
        yield pa.array([raw[at:stop]], type=pa.binary()).view(pa.string())
        at = stop


_CHUNK_SCHEMA = "kind string, chunk long, doc_id long, held_out boolean, ids binary, word binary, number int, n long"
_CHUNK_TYPES = pa.schema([("kind", pa.string()), ("chunk", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
                          ("ids", pa.binary()), ("word", pa.binary()), ("number", pa.int32()), ("n", pa.int64())])


def _rows(size: int, **columns) -> pa.RecordBatch:
    """Rows of a chunk; a column is an array or one value for all rows, and null if it is not given."""
    def column(name: str, kind: pa.DataType) -> pa.Array:
        value = columns.get(name)
        if value is None:
            return pa.nulls(size, kind)
        return value if isinstance(value, pa.Array) else pa.repeat(pa.scalar(value, kind), size)
    return pa.RecordBatch.from_arrays([column(f.name, f.type) for f in _CHUNK_TYPES], schema=_CHUNK_TYPES)


class _Dictionary:
    """Numbers of the distinct words of a chunk in the order in which they come, and their training counts."""

    def __init__(self):
        self.known, self.counts = pa.array([], pa.string()), np.zeros(0, dtype=np.int64)

    def numbers(self, words: pa.Array) -> np.ndarray:
        part = words.dictionary_encode()
        every = pa.concat_arrays([self.known, part.dictionary]).dictionary_encode()
        ids = every.indices.to_numpy()[len(self.known):][part.indices.to_numpy()]
        self.known = every.dictionary
        return ids.astype("<u4")

    def count(self, ids: np.ndarray) -> None:
        counts = np.bincount(ids, minlength=len(self.known))
        counts[:len(self.counts)] += self.counts
        self.counts = counts

    def rows(self, chunk: int) -> Iterator[pa.RecordBatch]:
        self.count(np.zeros(0, dtype=np.int64))  # of all words by now
        for at in range(0, len(self.known), 50_000):
            part = self.known[at:at + 50_000]
            yield _rows(len(part), kind="word", chunk=chunk, word=part.cast(pa.binary()), number=pa.array(np.arange(at, at + len(part)), pa.int32()),
                        n=pa.array(self.counts[at:at + len(part)]))


def _groups(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of successive texts of SEGMENT bytes at most; a longer text has a range to itself."""
    first, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > first and size + n > SEGMENT:
            yield first, i
            first, size = i, 0
        size += n
    if len(sizes):
        yield first, len(sizes)


def _cut_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = count(TaskContext.get().partitionId() << 24)
    chunk, known, tokens = next(number), _Dictionary(), 0
    for b in batches:
        texts, training = pc.fill_null(b.column("text").cast(pa.string()), ""), ~b.column("held_out").to_numpy(zero_copy_only=False)
        for i, j in _groups(pc.binary_length(texts).to_numpy()):
            if j == i + 1:
                parts = [known.numbers(_words(x)[0]) for x in _segments(texts[i:j])]
                ids = np.concatenate(parts) if parts else np.zeros(0, dtype="<u4")
                lengths = np.array([len(ids)])
            else:
                words, lengths = _words(texts[i:j])
                ids = known.numbers(words)
            known.count(ids[np.repeat(training[i:j], lengths)])
            ends = np.concatenate([[0], 4 * np.cumsum(lengths)]).astype("<i4")
            payload = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(ends), pa.py_buffer(ids)])
            yield _rows(j - i, kind="doc", chunk=chunk, doc_id=b.column("doc_id")[i:j], held_out=b.column("held_out")[i:j], ids=payload)
            tokens += len(ids)
            if tokens >= CHUNK_TOKENS or len(known.known) >= CHUNK_WORDS:
                yield from known.rows(chunk)
                chunk, known, tokens = next(number), _Dictionary(), 0
    yield from known.rows(chunk)


def _encode_chunk(docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
    """Units and summed logarithms of the documents of one chunk, from the counts of its words."""
    size = int(words["number"].max()) + 1 if len(words) else 0
    counts, codes = np.zeros(size, dtype=np.int64), np.zeros(size, dtype="<u4")
    counts[words["number"]], codes[words["number"]] = words["c"], words["code"]
    plus_one, log_count = np.log10(counts + 1.0), np.log10(np.maximum(counts, 1))
    out = []
    for doc_id, held_out, payload in zip(docs["doc_id"], docs["held_out"], docs["ids"], strict=True):
        ids = np.frombuffer(payload, dtype="<u4")
        out.append((doc_id, bool(held_out), len(ids), int((counts[ids] > 0).sum()), float(plus_one[ids].sum()),
                    float(log_count[ids].sum()), codes[ids].tobytes()))
    frame = pd.DataFrame(out, columns=["doc_id", "held_out", "n_words", "n_known", "plus_one", "log_count", "codes"])
    return frame.astype({"doc_id": "Int64"})


def _line(payload: bytes, ends: int, end: int) -> np.ndarray:
    """A training document's codes between ``ends`` end tokens before it and one after it."""
    codes = np.frombuffer(payload, dtype="<u4")
    line = np.full(len(codes) + ends + 1, end, dtype=np.int64)
    line[ends:-1] = codes
    return line


def _ngram_task(shared, cells: int, n: int, width: int):
    """Counts of ``n`` successive groups, numbers under ``width`` in the shared array by code; its last is the end token's."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, end = shared.value, len(shared.value) - 1
        total, held, size = np.zeros(cells, dtype=np.int64), [], 0
        for b in batches:
            for payload in b["codes"]:
                line = group[_line(payload, n - 1, end)].astype(np.int64)
                key = line[:len(line) - n + 1]
                for i in range(1, n):
                    key = key * width + line[i:len(line) - n + 1 + i]
                held.append(key)
                size += len(key)
                if size > 1_000_000:
                    total += np.bincount(np.concatenate(held), minlength=cells)
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=cells)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"key": at, "n": total[at]})
    return run


def _ngrams(training: DataFrame, group: np.ndarray, n: int, width: int) -> np.ndarray:
    shared = training.sparkSession.sparkContext.broadcast(group)
    out = _collected(training.mapInPandas(_ngram_task(shared, width ** n, n, width), "key long, n long"), width ** n)
    shared.unpersist()
    return out


def _collected(counts: DataFrame, cells: int) -> np.ndarray:
    """Counts of fewer than ``cells`` keys, whatever the size of the corpus, summed on the cluster and laid out here."""
    found = counts.groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(cells, dtype=np.int64)
    out[found["key"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, passes: int = PASSES) -> np.ndarray:
    """Class of every unit (the last unit, the end token, has class ``classes`` to itself).

    Units start in turn by frequency. Each is moved to the class with the greatest likelihood of the bigram counts,
    sum f(N(c, d)) - sum f(N(c, .)) - sum f(N(., d)) with f(x) = x log x; ties keep the smaller class.
    """
    units = len(bigrams)
    total = bigrams.sum(axis=1) + bigrams.sum(axis=0)
    order = np.lexsort((np.arange(units - 1), -total[:-1]))
    class_of = np.full(units, classes, dtype=np.int64)
    class_of[order] = np.arange(units - 1) % classes
    k = classes + 1
    member = np.zeros((units, k))
    member[np.arange(units), class_of] = 1
    counts = bigrams.astype(np.float64)
    right, left = counts @ member, counts.T @ member  # of a unit with each class after, and before, it
    between = member.T @ right
    for _ in range(passes):
        moved = 0
        for u in order:
            if not total[u]:
                continue
            r, b, own, a = right[u], left[u], counts[u, u], class_of[u]
            # Take the unit out of its class.
            r0, b0 = r.copy(), b.copy()
            r0[a] -= own
            b0[a] -= own
            between[a] -= r0
            between[:, a] -= b0
            between[a, a] -= own
            rows, cols = between.sum(axis=1) + b0, between.sum(axis=0) + r0
            # Put it into each class in turn.
            new_rows, new_cols = between + r0, between.T + b0
            gain = (_xlogx(new_rows) - _xlogx(between)).sum(axis=1) + (_xlogx(new_cols) - _xlogx(between.T)).sum(axis=1)
            d = np.diagonal(between)
            gain += _xlogx(d + r0 + b0 + own) - _xlogx(d + r0) - _xlogx(d + b0) + _xlogx(d)
            gain -= _xlogx(rows + r0.sum() + own) - _xlogx(rows) + _xlogx(cols + b0.sum() + own) - _xlogx(cols)
            gain[classes] = -np.inf
            best = int(np.argmax(gain))
            if gain[best] <= gain[a] + 1e-9:
                best = int(a)
            between[best] += r0
            between[:, best] += b0
            between[best, best] += own
            if best != a:
                moved += 1
                class_of[u] = best
                right[:, a] -= counts[:, u]
                right[:, best] += counts[:, u]
                left[:, a] -= counts[u]
                left[:, best] += counts[u]
        if not moved:
            break
    return class_of


def classes_for(words: int) -> int:
    """Twice the cube root of the clustered words, so that class trigrams grow with them; CLASSES to MAX_CLASSES."""
    return int(min(MAX_CLASSES, max(CLASSES, np.ceil(2 * np.cbrt(words)))))


def likelihood(between: np.ndarray) -> float:
    """What classes add to the log likelihood of all bigrams, from the counts of class bigrams."""
    return float(_xlogx(between).sum() - _xlogx(between.sum(axis=0)).sum() - _xlogx(between.sum(axis=1)).sum())


def _planes(x: np.ndarray, size: int) -> bytes:
    """Numbers of ``size`` bytes, first all their lowest bytes, which leaves little of small numbers once compressed."""
    return np.ascontiguousarray(x.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T).tobytes()


def _of_planes(raw: bytes, size: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(size, -1).T).view(f"<u{size}").ravel().astype(np.int64)


def _pair_task(starts: np.ndarray):
    """Counts of (word, code after it) and (word, code before it), a row for each bucket of words: successive keys'
    differences, and counts. Key: place in the bucket, times 2 (codes), plus the code (before: plus codes)."""
    end = int(starts[-1])
    codes = end + 1

    def send(every: np.ndarray) -> Iterator[pd.DataFrame]:
        every.sort()
        at = np.concatenate([[0], np.flatnonzero(every[1:] != every[:-1]) + 1])
        key, n = every[at], np.diff(at, append=len(every))
        del at
        cut = np.searchsorted(key, starts * (2 * codes))
        rows = ((b, _planes(np.diff(key[i:j], prepend=starts[b] * (2 * codes)), 8), _planes(n[i:j], 4))
                for b, (i, j) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if j > i)
        while some := list(islice(rows, 16)):
            yield pd.DataFrame(some, columns=["bucket", "keys", "n"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = np.empty(NEIGHBOURS, dtype=np.int64), 0
        for b in batches:
            # All documents of a batch in one line, each between two end tokens.
            parts = [np.frombuffer(p, dtype="<u4") for p in b["codes"]]
            line = np.full(sum(map(len, parts)) + len(parts) + 1, end, dtype=np.int64)
            at = 1
            for p in parts:
                line[at:at + len(p)] = p
                at += len(p) + 1
            inner = line[1:-1]
            words = inner != end
            word = inner[words] * (2 * codes)
            for beside, side in ((line[2:], 0), (line[:-2], codes)):
                keys = word + beside[words] + side
                while len(keys):
                    some, keys = keys[:NEIGHBOURS - size], keys[NEIGHBOURS - size:]
                    held[size:size + len(some)] = some
                    size += len(some)
                    if size == NEIGHBOURS:
                        yield from send(held)
                        size = 0
        if size:
            yield from send(held[:size])
    return run


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their counts, from several such, which are taken out of the list."""
    if len(held) == 1:
        return held.pop()
    key, n = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
    held.clear()
    order = np.argsort(key, kind="stable")  # merges sorted runs
    key, n = key[order], n[order]
    del order
    at = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    return key[at], np.add.reduceat(n, at)


def _side(place: np.ndarray, code: np.ndarray, n: np.ndarray, words: int) -> bytes:
    """Neighbours of a bucket's words on one side: how many each word has, their codes, counts of a byte, and what
    larger counts have beyond it."""
    more = np.flatnonzero(n > 255)
    sizes = np.array([words, len(code), len(more)], dtype="<i8")
    columns = (np.bincount(place, minlength=words).astype("<u4"), code.astype("<u4"), np.minimum(n, 255).astype("<u1"),
               more.astype("<u4"), (n[more] - 255).astype("<i8"))
    return b"".join([sizes.tobytes(), *[x.tobytes() for x in columns]])


def _of_side(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the word, code and count (as a double) of every pair."""
    words, pairs, more = np.frombuffer(raw, dtype="<i8", count=3)
    at, out = 24, []
    for kind, size in (("<u4", words), ("<u4", pairs), ("<u1", pairs), ("<u4", more), ("<i8", more)):
        out.append(np.frombuffer(raw, dtype=kind, count=size, offset=at))
        at += out[-1].nbytes
    lengths, code, n, larger, beyond = out
    n = n.astype(np.float64)
    n[larger] += beyond
    return np.repeat(np.arange(words), lengths), code, n


def _merge_task(starts: np.ndarray):
    """Sums the pairs of each bucket, whose rows come one after the other: a row for each bucket, or several parts
    (which may share pairs) of one with very many."""
    codes = int(starts[-1]) + 1

    def row(bucket: int, part: int, held: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
        key, n = _merged(held)
        line, code = np.divmod(key, codes)
        place, words = line // 2, int(starts[bucket + 1] - starts[bucket])
        after, before = line % 2 == 0, line % 2 == 1
        first = before & (code == codes - 1)
        begins = np.zeros(words, dtype="<i8")
        begins[place[first]] = n[first]
        return pd.DataFrame({"bucket": [bucket], "part": [part], "begins": [begins.tobytes()],
                             **{name: [_side(place[x], code[x], n[x], words)] for name, x in (("after", after), ("before", before))}})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, part, held, size = None, 0, [], 0
        for b in batches:
            for of, keys, n in zip(b["bucket"], b["keys"], b["n"], strict=True):
                if of != bucket:
                    if held:
                        yield row(bucket, part, held)
                    bucket, part, held, size = of, 0, [], 0
                held.append((np.cumsum(_of_planes(keys, 8)), _of_planes(n, 4)))
                size += len(held[-1][0])
                if size > PAIRS:
                    held = [_merged(held)]
                    size = len(held[0][0])
                    if size > PAIRS // 2:
                        yield row(bucket, part, held)
                        part, held, size = part + 1, [], 0
        if held:
            yield row(bucket, part, held)
    return run


def dealt_codes(own: int) -> np.ndarray:
    """First codes of the buckets of ``own`` clustered words, 64 of few words and more of DEALT_WORDS, then of the shapes;
    last, the end token."""
    step = min(DEALT_WORDS, max(1, -(-own // 64)))
    return np.concatenate([np.arange(0, own, step), np.arange(own, own + SHAPES + 1, DEALT_SHAPES)])


def word_pairs(training: DataFrame, starts: np.ndarray) -> DataFrame:
    """Which codes come after and before the words of each bucket, and how often: a written table that passes read
    without an exchange. Codes from ``starts[b]`` to ``starts[b + 1]`` are a bucket; the last of ``starts`` is the end token."""
    shared_folder(training.sparkSession)
    sent = training.mapInPandas(_pair_task(starts), "bucket int, keys binary, n binary")
    dealt = sent.repartition(len(starts) - 1, "bucket").sortWithinPartitions("bucket")
    return materialize(dealt.mapInPandas(_merge_task(starts), "bucket int, part int, begins binary, after binary, before binary"), "brown-pairs")


def _between_task(shared, groups: int):
    """Counts of successive groups of codes: those that words begin, or that they are after the end token, the last group."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group_of, starts = shared.value
        total = np.zeros(groups ** 2)
        for b in batches:
            for bucket, begins, after in zip(b["bucket"], b["begins"], b["after"], strict=True):
                now = group_of[starts[bucket]:starts[bucket + 1]].astype(np.int64)
                place, code, n = _of_side(after)
                total += np.bincount((now * groups)[place] + group_of[code], weights=n, minlength=groups ** 2)
                total[-groups:] += np.bincount(now, weights=np.frombuffer(begins, dtype="<i8"), minlength=groups)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"key": at, "n": total[at].astype(np.int64)})
    return run


def _between(pairs: DataFrame, group_of: np.ndarray, starts: np.ndarray, groups: int, documents: int) -> np.ndarray:
    """Counts of successive groups in as many training documents; the last group is the end token's."""
    shared = pairs.sparkSession.sparkContext.broadcast((group_of, starts))
    out = _collected(pairs.select("bucket", "begins", "after").mapInPandas(_between_task(shared, groups), "key long, n long"), groups ** 2)
    shared.unpersist()
    out = out.reshape(groups, groups)
    out[-1, -1] += documents - out[-1].sum()  # empty documents: an end token after another
    return out


def best_classes(neighbours: np.ndarray, between: np.ndarray, now: np.ndarray) -> np.ndarray:
    """The class that explains each word's neighbours best: rows have counts of classes after, then before, the word.

    Of class c, after it d: (N(c, d) + N(., d) / N) / (N(c, .) + 1), and before it alike; ties keep the class of now,
    then the smaller. The last class is the end token's alone. A word without neighbours stays.
    """
    def table(n: np.ndarray) -> np.ndarray:
        one = n.sum(axis=0) + 1e-9
        return np.log((n + one / one.sum()) / (n.sum(axis=1, keepdims=True) + 1))
    score = neighbours @ np.concatenate([table(between), table(between.T)], axis=1).T
    score[:, -1] = -np.inf
    at, best = np.arange(len(now)), score.argmax(axis=1)
    stays = score[at, now]
    return np.where(score[at, best] > stays + 1e-9 * np.abs(stays), best, now)


def _neighbours(after: bytes, before: bytes, class_of: np.ndarray, words: int, classes: int) -> np.ndarray:
    """Counts of the classes after, then before, each word of a bucket."""
    width, out = 2 * (classes + 1), np.zeros(words * 2 * (classes + 1))
    for at, raw in ((0, after), (classes + 1, before)):
        place, code, n = _of_side(raw)
        out += np.bincount(place * width + at + class_of[code], weights=n, minlength=len(out))
    return out


def _moved(bucket: int, neighbours: np.ndarray, given: tuple, classes: int) -> tuple[int, bytes]:
    class_of, starts, between = given
    now = class_of[starts[bucket]:starts[bucket + 1]].astype(np.int64)
    return bucket, best_classes(neighbours.reshape(len(now), 2 * (classes + 1)), between, now).astype("<u2").tobytes()


def _move_task(shared, classes: int):
    """The classes that the words of each bucket, given whole, move to, two bytes a word."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        class_of, starts, _ = shared.value
        for b in batches:
            out = [_moved(bucket, _neighbours(after, before, class_of, int(starts[bucket + 1] - starts[bucket]), classes), shared.value, classes)
                   for bucket, after, before in zip(b["bucket"], b["after"], b["before"], strict=True)]
            yield pd.DataFrame(out, columns=["bucket", "classes"])
    return run


def _part_task(shared, classes: int):
    """Neighbour counts of each part of a bucket."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        class_of, starts, _ = shared.value
        for b in batches:
            for bucket, after, before in zip(b["bucket"], b["after"], b["before"], strict=True):
                n = _neighbours(after, before, class_of, int(starts[bucket + 1] - starts[bucket]), classes)
                at = np.flatnonzero(n)
                yield pd.DataFrame({"bucket": [bucket], "at": [at.astype("<u4").tobytes()], "n": [n[at].astype("<i8").tobytes()]})
    return run


def _move_parts_task(shared, classes: int):
    """As ``_move_task``, from the counts of the parts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts = shared.value[1]
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for bucket, at, n in zip(b["bucket"], b["at"], b["n"], strict=True):
                if bucket not in total:
                    total[bucket] = np.zeros(int(starts[bucket + 1] - starts[bucket]) * 2 * (classes + 1))
                total[bucket][np.frombuffer(at, dtype="<u4")] += np.frombuffer(n, dtype="<i8")
        if total:
            yield pd.DataFrame([_moved(bucket, n, shared.value, classes) for bucket, n in total.items()], columns=["bucket", "classes"])
    return run


def exchange_all(training: DataFrame, class_of: np.ndarray, starts: np.ndarray, classes: int, passes: int = PASSES,
                 pairs: DataFrame | None = None) -> np.ndarray:
    """Class of every clustered word and shape (and, last, the end token's), from those to start with.

    ``training`` has codes; ``pairs`` are its ``word_pairs``, if they are there already.
    """
    if pairs is None:
        pairs = word_pairs(training, starts)
        try:
            return exchange_all(training, class_of, starts, classes, passes, pairs)
        finally:
            release(pairs)
    sc = pairs.sparkSession.sparkContext
    best, parts = None, 1
    number = np.arange(len(class_of))
    documents = training.count()
    split = [r["bucket"] for r in pairs.where("part > 0").select("bucket").distinct().collect()]
    sides, moves = pairs.select("bucket", "after", "before"), "bucket int, classes binary"
    for step in range(passes + 1):
        between = _between(pairs, class_of, starts, classes + 1, documents).astype(np.float64)
        value = likelihood(between)
        if best is not None and value <= best[0] + 1e-9 * abs(best[0]):
            if parts == 4:
                return best[1]
            parts *= 2
            _, class_of, moved = best
        else:
            if step == passes:
                return class_of
            shared = sc.broadcast((class_of, starts, between))
            found = sides.where(~F.col("bucket").isin(split)).mapInPandas(_move_task(shared, classes), moves)
            if split:
                counts = sides.where(F.col("bucket").isin(split)).mapInPandas(_part_task(shared, classes), "bucket int, at binary, n binary")
                found = found.union(counts.repartition(len(split), "bucket").mapInPandas(_move_parts_task(shared, classes), moves))
            moved = class_of.copy()
            for r in found.collect():
                moved[starts[r["bucket"]]:starts[r["bucket"] + 1]] = np.frombuffer(r["classes"], dtype="<u2")
            shared.unpersist()
            if (moved == class_of).all():
                return class_of
            best = value, class_of, moved
        class_of = np.where(number % parts == step % parts, moved, class_of).astype(class_of.dtype)
    return best[1]


class Model:
    """Logarithms (base 10) of class transitions, and of what a token's code adds to its count."""

    def __init__(self, class_of: np.ndarray, trigrams: np.ndarray, tokens: np.ndarray, once: np.ndarray, own: int = OWN_UNITS,
                 by_class: bool = False):
        """``tokens`` and ``once`` by unit, or by class; the units are ``own`` words, SHAPES shapes and the end token."""
        k = int(class_of.max()) + 1
        three = trigrams.reshape(k, k, k).astype(np.float64)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        p1 = (one + 1) / (one.sum() + k)
        p2 = (two + (kinds := (two > 0).sum(axis=1, keepdims=True)) * p1) / np.maximum(two.sum(axis=1, keepdims=True) + kinds, 1e-300)
        p2 = np.where(kinds > 0, p2, p1)
        kinds = (three > 0).sum(axis=2, keepdims=True)
        p3 = (three + kinds * p2) / np.maximum(three.sum(axis=2, keepdims=True) + kinds, 1e-300)
        self.transition = np.log10(np.where(kinds > 0, p3, p2[None]))
        # Only units of shapes hold unseen words; classes of frequent words alone keep no mass for them.
        size = tokens if by_class else np.bincount(class_of, weights=tokens, minlength=k)
        single = once if by_class else np.bincount(class_of, weights=once, minlength=k)
        shaped = np.bincount(class_of[own:own + SHAPES], minlength=k) > 0
        unseen = np.where(shaped, (single + 1) / (size + 2), 0.0)
        unseen[size == 0] = 1.0
        self.known = np.log10(np.maximum((1 - unseen) / np.maximum(size, 1), 1e-300))
        self.unseen = np.log10(np.maximum(unseen, 1e-300))
        self.class_of, self.end, self.unseen_at = class_of, own + SHAPES, max(UNSEEN, own + UNITS)

    @property
    def emission(self) -> np.ndarray:
        """By code: of a unit, and from ``UNSEEN`` on of a unit's unseen words."""
        out = np.zeros(UNSEEN + len(self.class_of))
        out[:len(self.class_of)], out[UNSEEN:] = self.known[self.class_of], self.unseen[self.class_of]
        return out

    def score(self, codes: np.ndarray) -> float:
        """Of a document's word codes and its end, without the logarithms of the words' counts."""
        unseen = codes >= self.unseen_at
        group = self.class_of[np.concatenate([[self.end, self.end], np.where(unseen, codes - self.unseen_at, codes), [self.end]])].astype(np.int64)
        emitted = np.where(unseen, self.unseen[group[2:-1]], self.known[group[2:-1]])
        return float(self.transition[group[:-2], group[1:-1], group[2:]].sum() + emitted.sum() + self.known[group[-1]])


def _size_task(shared, classes: int):
    """Tokens, words seen once, and words by class."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((3, classes + 1), dtype=np.int64)
        for b in batches:
            group, c = shared.value[b["code"].to_numpy(dtype=np.int64)], b["c"].to_numpy(dtype=np.int64)
            np.add.at(total, (0, group), c)
            np.add.at(total, (1, group), c == 1)
            np.add.at(total, (2, group), 1)
        yield pd.DataFrame({"class": np.arange(classes + 1), "tokens": total[0], "once": total[1], "words": total[2]})
    return run


def _score_task(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["model"] = [shared.value.score(np.frombuffer(c, dtype="<u4").astype(np.int64)) for c in b["codes"]]
            yield b.drop(columns="codes")
    return run


def _packed_shapes(words: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"bucket": words["bucket"].iloc[:1], "shapes": [words.sort_values("place")["shape"].to_numpy().astype("<u2").tobytes()]})


def brown_scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens (words and one end), n_known (known to training), train_tokens,
    base_score, score (base-10 logarithms of the text's probability by unigrams, and by the class model), perplexity.

    Words are runs of anything but ASCII white space, A-Z lowered; ``held_out`` (a condition on the columns of ``docs``,
    null: false) keeps documents from training. Null text is empty: its end alone is scored. Repeated rows and null
    doc_ids are scored as they come. Without training documents both scores are 0. An empty table gives an empty
    result. Other columns are read by ``held_out`` only.
    """
    spark = docs.sparkSession
    small_batches(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    shared_folder(spark)
    chunks = materialize(rows.mapInArrow(_cut_chunks, _CHUNK_SCHEMA), "brown-chunks")
    texts = chunks.where("kind = 'doc'").select("chunk", "doc_id", "held_out", "ids")
    train_docs = texts.where("NOT held_out").count()

    word = Window.partitionBy("word")
    known = chunks.where("kind = 'word'").select("chunk", "number", "word", "n") \
        .withColumn("c", F.sum("n").over(word)).withColumn("first", F.row_number().over(word.orderBy("chunk")) == 1)
    shape = (F.crc32(F.expr("substring(word, -4, 4)")) % SHAPES + OWN_UNITS).cast("int")
    known = written(known.select("chunk", "number", "c", "first", shape.alias("shape"),
                                 F.when(F.col("c") >= OWN_COUNT, F.xxhash64("word")).alias("h")), "brown-words")
    # Numbers of the clustered words: places in buckets dealt by hash, one bucket after the other; the shapes come last.
    frequent = known.where("first AND h IS NOT NULL").select("h", "c", "shape")
    buckets = max(1, frequent.count() // DEALT_WORDS)
    place = Window.partitionBy("bucket").orderBy("h", "c", "shape")
    frequent = written(frequent.withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int"))
                       .withColumn("place", F.row_number().over(place) - 1), "brown-frequent")
    held = {r["bucket"]: r["count"] for r in frequent.groupBy("bucket").count().collect()}
    starts = np.cumsum([0, *[held.get(b, 0) for b in range(buckets)]])
    own = int(starts[-1])
    classes = classes_for(own)
    top = frequent.orderBy(F.desc("c"), "h").limit(OWN_UNITS).select("bucket", "place").collect()
    unit_of = np.zeros(own + SHAPES + 1, dtype=np.uint16)
    for r in frequent.groupBy("bucket").applyInPandas(_packed_shapes, "bucket int, shapes binary").collect():
        unit_of[starts[r["bucket"]]:starts[r["bucket"] + 1]] = np.frombuffer(r["shapes"], dtype="<u2")
    unit_of[own:] = np.arange(OWN_UNITS, UNITS)
    unit_of[[starts[r["bucket"]] + r["place"] for r in top]] = np.arange(len(top))

    offsets = spark.createDataFrame([(b, int(at)) for b, at in enumerate(starts[:-1])], "bucket int, start long")
    numbered = frequent.join(F.broadcast(offsets), "bucket").select("h", F.col("c").alias("_c"), F.col("shape").alias("_s"), (F.col("start") + F.col("place")).alias("own"))
    of_shape = F.col("shape") + (own - OWN_UNITS)
    same = (F.col("known.h") == F.col("numbered.h")) & (F.col("c") == F.col("_c")) & (F.col("shape") == F.col("_s"))
    known = known.alias("known").join(numbered.alias("numbered"), same, "left").withColumn(
        "code", F.when(F.col("c") > 0, F.coalesce("own", of_shape)).otherwise(of_shape + max(UNSEEN, own + UNITS))).select("chunk", "number", "c", "first", "code")

    counted = known.select("chunk", "number", "c", "code")
    encoded = written(texts.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInPandas(
        _encode_chunk, "doc_id long, held_out boolean, n_words long, n_known long, plus_one double, log_count double, codes binary"), "brown-codes")
    release(chunks)
    training = encoded.where("NOT held_out").select("codes")
    dealt = dealt_codes(own)
    pairs = word_pairs(training, dealt)
    try:
        start_of = exchange(_between(pairs, unit_of, dealt, UNITS, train_docs), classes).astype(np.uint16)
        class_of = exchange_all(training, start_of[unit_of], dealt, classes, pairs=pairs)
    finally:
        release(pairs)
    trigrams = _ngrams(training, class_of, 3, classes + 1)

    group = spark.sparkContext.broadcast(class_of)
    sizes = known.where("first AND c > 0").select("code", "c").mapInPandas(_size_task(group, classes), "class int, tokens long, once long, words long") \
        .groupBy("class").agg(*[F.sum(x).alias(x) for x in ("tokens", "once", "words")]).toPandas()
    tokens, once, words = (np.bincount(sizes["class"], weights=sizes[x], minlength=classes + 1) for x in ("tokens", "once", "words"))
    tokens[classes] = train_docs
    n_train, n_words = int(tokens.sum()), int(words.sum()) + (train_docs > 0)
    shared = spark.sparkContext.broadcast(Model(class_of, trigrams, tokens, once, own, by_class=True))

    scored = encoded.mapInPandas(_score_task(shared), "doc_id long, held_out boolean, n_words long, n_known long, plus_one double, log_count double, model double")
    n = F.col("n_words") + 1
    trained = F.lit(train_docs > 0)
    base = F.col("plus_one") + float(np.log10(train_docs + 1)) - n * float(np.log10(n_train + n_words + 1))
    model = F.col("model") + F.col("log_count") + float(np.log10(max(train_docs, 1)))
    score = F.when(trained, model).otherwise(F.lit(0.0))
    return scored.select("doc_id", "held_out", n.alias("n_tokens"), (F.col("n_known") + (F.lit(1) if train_docs else F.lit(0))).alias("n_known"),
                         F.lit(n_train).cast("long").alias("train_tokens"), F.when(trained, base).otherwise(F.lit(0.0)).alias("base_score"),
                         score.alias("score"), F.pow(F.lit(10.0), -score / n).alias("perplexity"))


def seventh_held_out() -> Column:
    """Documents whose crc32 of the id leaves 2 modulo 7."""
    return fold() % 7 == 2
