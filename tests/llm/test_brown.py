import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import towerlens.llm.brown as brown
from towerlens.llm.brown import CLASSES, END, OWN_UNITS, UNITS, UNSEEN, Model, brown_scores, exchange, seventh_held_out

from .conftest import EDGE

SF = "/root/testdata/sf0.001"


def likelihood(counts, classes, k):
    member = np.zeros((len(counts), k + 1))
    member[np.arange(len(counts)), classes] = 1
    n = member.T @ counts @ member
    f = brown._xlogx
    return f(n).sum() - f(n.sum(0)).sum() - f(n.sum(1)).sum()


def test_exchange_climbs_to_a_local_optimum():
    rng = np.random.default_rng(0)
    true = rng.integers(0, 4, 41)
    counts = rng.poisson(30 * (rng.random((4, 4)) ** 6)[true][:, true] * rng.random((41, 1)))
    values = [likelihood(counts, exchange(counts, 4, p), 4) for p in range(5)]
    assert all(b >= a - 1e-6 for a, b in zip(values, values[1:], strict=False))
    best = exchange(counts, 4, 30)
    for u in range(40):
        for c in range(4):
            other = best.copy()
            other[u] = c
            assert likelihood(counts, other, 4) <= likelihood(counts, best, 4) + 1e-6


def test_model_is_a_distribution():
    rng = np.random.default_rng(1)
    class_of = np.append(rng.integers(0, CLASSES, UNITS - 1), CLASSES)
    k = CLASSES + 1
    model = Model(class_of, rng.poisson(0.05, k ** 3), rng.integers(1, 50, UNITS).astype(float), np.where(np.arange(UNITS) < OWN_UNITS, 0, 1.0))
    assert np.allclose((10 ** model.transition).sum(axis=2), 1)
    size = np.bincount(class_of, weights=np.ones(UNITS), minlength=k)
    assert size.min() > 0
    # a class gives its known tokens and one unseen symbol all of its mass
    tokens = rng.integers(1, 50, UNITS).astype(float)
    model = Model(class_of, rng.poisson(0.05, k ** 3), tokens, np.where(np.arange(UNITS) < OWN_UNITS, 0, 1.0))
    mass = np.bincount(class_of, weights=tokens * 10 ** model.emission[:UNITS], minlength=k)
    shaped = np.bincount(class_of[OWN_UNITS:END], minlength=k) > 0
    unseen = np.zeros(k)
    unseen[class_of] = 10 ** model.emission[UNSEEN:]
    assert np.allclose(mass + np.where(shaped, unseen, 0), 1)


def brute(rows, held):
    words = [(t or "").encode().lower().split() for _, t in rows]
    counts = Counter()
    for w, h in zip(words, held, strict=True):
        if not h:
            counts.update(w)
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    return [(len(w) + 1, sum(counts[x] > 0 for x in [*w, None]), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in [*w, None])) for w in words]


@pytest.mark.parametrize("chunk", [4_000_000, 300])
def test_counts_and_base_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(brown, "CHUNK_TOKENS", chunk)
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(4)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    held = [zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    expected = {d: (h, *b) for (d, _), h, b in zip(rows, held, brute(rows, held), strict=True)}
    got = brown_scores(docs, seventh_held_out()).collect()
    assert len(got) == len(rows)
    for r in got:
        h, n, known, total, base = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, known, total)
        assert abs(r.base_score - base) < 1e-6 * abs(base)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 0.2 * sum(r.n_tokens for r in out)
    assert all(abs(r.perplexity - 10 ** (-r.score / r.n_tokens)) < 1e-6 * r.perplexity for r in got)


def test_edge_rows(edge_docs, no_docs):
    rows = [(d, t) for d, t, *_ in EDGE]
    got = brown_scores(edge_docs, F.col("doc_id") == 3).collect()
    held = [d == 3 for d, _ in rows]
    order = lambda xs: sorted((n, k, t, round(b, 6)) for n, k, t, b in xs)
    assert order((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got) == order(brute(rows, held))
    assert all(r.score < 0 for r in got)
    assert brown_scores(no_docs, seventh_held_out()).count() == 0
    none = brown_scores(edge_docs, F.lit(True)).collect()
    assert all((r.n_known, r.train_tokens, r.base_score, r.score) == (0, 0, 0.0, 0.0) for r in none)


def test_words_beyond_the_most_frequent_get_a_class_of_their_own_neighbours(spark):
    lines = [f"the n{i:03d} to v{i:03d}" for i in range(450)] * 30 + ["the leftzzzz"] * 25 + ["to rightzzzz"] * 25
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*lines, "the leftzzzz", "the rightzzzz", "to leftzzzz", "to rightzzzz"])], "doc_id long, text string")
    got = {r.doc_id - len(lines): r.score for r in brown_scores(docs, F.col("doc_id") >= len(lines)).where("held_out").collect()}
    assert got[0] > got[1] + 0.5
    assert got[3] > got[2] + 0.5


def test_passes_over_all_words_raise_the_likelihood(spark):
    rng = np.random.default_rng(2)
    shapes, classes, words = brown.SHAPES, 8, 300
    starts = np.array([0, 120, words, words + shapes])
    end = words + shapes
    group = rng.integers(0, 4, end)
    lines = []
    for _ in range(600):
        at, line = int(rng.integers(end)), []
        for _ in range(int(rng.integers(0, 40))):
            line.append(at)
            at = int(rng.choice(np.flatnonzero(group == (group[at] + 1) % 4)))
        lines.append(line)
    training = spark.createDataFrame([(bytearray(np.array(x, dtype="<u4").tobytes()),) for x in lines], "codes binary").repartition(3)
    counts = np.zeros((end + 1, end + 1), dtype=np.int64)
    for x in lines:
        np.add.at(counts, ([end, *x], [*x, end]), 1)
    first = np.append(rng.integers(0, classes, end), classes).astype(np.uint16)
    values = [likelihood(counts, brown.exchange_all(training, first, starts, classes, p), classes) for p in (0, 1, 30)]
    assert values[0] == pytest.approx(likelihood(counts, first, classes)) and values[0] < values[1] < values[2]
    # stops where no word explains its neighbours better elsewhere, or where no part of the moves raises the likelihood
    best = brown.exchange_all(training, first, starts, classes, 30)
    member = np.eye(classes + 1)[best]
    neighbours, between = np.concatenate([counts @ member, counts.T @ member], axis=1)[:-1], member.T @ counts @ member
    moved = np.append(brown.best_classes(neighbours, between, best[:-1].astype(int)), classes)
    assert likelihood(counts, moved, classes) <= values[2] + 1e-6 * abs(values[2])


def test_classes_grow_with_the_words():
    assert [brown.classes_for(n) for n in (0, 16_797, 100_000, 1_000_000, 10 ** 9)] == [64, 64, 93, 200, 256]


def _lines(spark, rng, end, rows=300):
    lines = [[*rng.zipf(1.3, int(rng.integers(0, 40))) % end] for _ in range(rows)] + [[], [3] * 600]
    counts = np.zeros((end + 1, end + 1), dtype=np.int64)
    for x in lines:
        np.add.at(counts, ([end, *x], [*x, end]), 1)
    return spark.createDataFrame([(bytearray(np.array(x, dtype="<u4").tobytes()),) for x in lines], "codes binary").repartition(3), len(lines), counts


@pytest.mark.parametrize("limit", [4_000_000, 50])
def test_pairs_of_words_are_counted_once_and_read_by_every_pass(spark, monkeypatch, limit):
    monkeypatch.setattr(brown, "PAIRS", limit)
    monkeypatch.setattr(brown, "NEIGHBOURS", 4 * limit)
    rng = np.random.default_rng(3)
    end, classes = 200 + brown.SHAPES, 8
    starts = np.array([0, 90, 90, 200, 200 + brown.SHAPES // 2, end])
    training, documents, counts = _lines(spark, rng, end)
    pairs = brown.word_pairs(training, starts)
    assert (pairs.where("part > 0").count() > 0) == (limit == 50)
    assert (brown._between(pairs, np.arange(end + 1, dtype=np.uint32), starts, end + 1, documents) == counts).all()
    brown.release(pairs)
    # every pass moves words by the counts of all documents, which are read for the pairs and for their number only
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(len(b))
            yield b

    first = np.append(rng.integers(0, classes, end), classes).astype(np.uint16)
    got = brown.exchange_all(training.mapInPandas(seen, "codes binary"), first, starts, classes, 1)
    member = np.eye(classes + 1)[first]
    neighbours, between = np.concatenate([counts @ member, counts.T @ member], axis=1)[:-1], member.T @ counts @ member
    assert (got == np.append(brown.best_classes(neighbours, between, first[:-1].astype(int)), classes)).all()
    read.value = 0
    brown.exchange_all(training.mapInPandas(seen, "codes binary"), first, starts, classes, 6)
    assert read.value == 2 * documents


@pytest.mark.parametrize(("segment", "tokens", "words"), [(4 << 20, 4_000_000, 500_000), (40, 30, 500_000), (7, 10 ** 9, 12), (1, 1, 1)])
def test_words_of_chunks_are_the_words_of_the_texts(monkeypatch, segment, tokens, words):
    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 3)

    for name, value in (("TaskContext", Task), ("SEGMENT", segment), ("CHUNK_TOKENS", tokens), ("CHUNK_WORDS", words)):
        monkeypatch.setattr(brown, name, value)
    texts = ["", None, " \t\n ", "One two\x0bONE\x0cthree\r\n", "Ä ä  É x \x1c\x00 \U0001f600", "one", "a" * 60 + " b", " ".join(f"W{i % 9}" for i in range(40))] * 3
    rows = [(None if i == 4 else i, i % 3 == 0, t) for i, t in enumerate(texts)]
    batch = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.bool_(), pa.string()), strict=True)], names=["doc_id", "held_out", "text"])
    out = pa.Table.from_batches(brown._cut_chunks(iter([batch.slice(0, 5), batch.slice(5, 0), batch.slice(5)]))).to_pylist()
    known = {(r["chunk"], r["number"]): r for r in out if r["kind"] == "word"}
    assert len({(r["chunk"], r["word"]) for r in known.values()}) == len(known)
    docs = [(r["doc_id"], r["held_out"], [known[r["chunk"], n]["word"] for n in np.frombuffer(r["ids"], dtype="<u4").tolist()]) for r in out if r["kind"] == "doc"]
    assert docs == [(d, h, (t or "").encode().lower().split()) for d, h, t in rows]
    counts = Counter()
    for r in known.values():
        counts[r["word"]] += r["n"]
    assert counts == Counter(w for _, h, x in docs if not h for w in x)
