import random
import re

import numpy as np

from towerlens.llm.winnowing import Block, contamination, drop_contaminated, find, gram_hashes, normalise, winnow, word_hashes

from .conftest import EDGE

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def brute(items, text):
    w, hit, found = words(text), set(), set()
    for name, item in items:
        v = words(item)
        n = min(10, len(v))
        windows = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(name))
    return len(w), sorted(hit), sorted(found)


def planted(n=200):
    rnd = random.Random(2)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(12)]  # few words: many near hits and repeats
    line = lambda k: " ".join(rnd.choice(vocabulary) for _ in range(k))
    items = [(i, line(rnd.choice([1, 3, 5, 8, 9, 10, 12, 30]))) for i in range(25)] + [(90, ""), (91, "--- !!"), (92, None), (93, "w1, W2")]
    texts = []
    for _ in range(n):
        part = rnd.choice(items)[1] or ""
        texts.append(line(rnd.randint(0, 40)) + rnd.choice([" ", "\n", "...", "-"]) + part.upper() + " " + line(rnd.randint(0, 40)))
    return items, texts


def test_hits_equal_brute_force():
    items, texts = planted()
    block = Block([(str(i), normalise(t)) for i, t in items])
    for text, (n, hit, found) in zip(texts, find(block, texts), strict=True):
        assert (n, hit.tolist(), sorted(found)) == brute(items, text)


def test_every_window_holds_a_picked_hash():
    h = np.random.default_rng(0).integers(0, 50, 500).astype(np.uint64)
    picked = set(winnow(h, 6).tolist())
    assert all(picked & set(range(i, i + 6)) for i in range(len(h) - 5))


def test_equal_words_hash_equal_wherever_they_stand():
    raw = b"abc de  abc " * 3
    h, s, e = word_hashes(raw)
    assert len({int(x) for x in h}) == 2 and {raw[a:b] for a, b in zip(s, e, strict=True)} == {b"abc", b"de"}
    assert len(gram_hashes(h, 20)) == 0


def test_operator_on_edge_rows(spark, edge_docs, no_docs):
    items = [(1, "big world of words"), (2, "a very long text of many words a very long text"), (None, "nothing of this"), (3, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    judged, column = contamination(edge_docs, benchmark)
    assert judged.columns == [*edge_docs.columns, column]
    for r in judged.collect():
        assert (r[column].n_words, r[column].hit_words, r[column].items) == brute([(1, items[0][1]), (2, items[1][1]), ("", items[2][1])], r.text)
    assert contamination(no_docs, benchmark)[0].count() == 0
    assert drop_contaminated(edge_docs, benchmark.limit(0)).count() == len(EDGE)
    left = drop_contaminated(edge_docs, benchmark)
    assert left.columns == edge_docs.columns and {r.doc_id for r in left.collect()} == {None, 1, 2, 7, 8, 9}


def test_a_benchmark_of_several_blocks(spark, monkeypatch):
    import towerlens.llm.winnowing as module
    monkeypatch.setattr(module, "BLOCK_BYTES", 40)
    items, texts = planted(30)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    judged, column = contamination(docs, spark.createDataFrame([(i, t) for i, t in items[:6]], "item_id long, text string"))
    for r in judged.collect():
        assert (r[column].n_words, r[column].hit_words, r[column].items) == brute(items[:6], r.text)
