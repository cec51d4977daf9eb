import numpy as np
import pandas as pd
import pytest

from towerlens.llm.long_repeats import _Bucket, _Repeats, remove_long_repeats
from towerlens.llm.run_index import RunLengthIndex

from .conftest import EDGE


def test_index_against_sorted_suffixes():
    rng = np.random.default_rng(0)
    for _ in range(80):
        k = int(rng.integers(1, 8))
        texts = [bytes(rng.integers(97, 97 + rng.integers(1, 4), rng.integers(0, 30), dtype=np.uint8)) for _ in range(k)]
        owners, length = rng.integers(0, 9, k), int(rng.integers(1, 6))
        index = RunLengthIndex(texts)
        suffixes = sorted((texts[index.text_of[i]][len(texts[index.text_of[i]]) - index.left[i]:], i) for i in range(len(index.text)))
        assert [i for _, i in suffixes] == index.suffixes.tolist()
        shared = [0] + [next((n for n, (x, y) in enumerate(zip(a + b"\x01", b + b"\x02", strict=False)) if x != y), 0)
                        for (a, _), (b, _) in zip(suffixes, suffixes[1:], strict=False)]
        assert index.common_prefixes().tolist() == shared
        assert index.run_lengths.sum() == len(index.text)
        got, at = index.smallest_owner(owners, length), 0
        for t in texts:
            for i in range(len(t) + 1):
                w = t[i:i + length]
                expected = min(int(o) for u, o in zip(texts, owners, strict=True) if w in u) if len(w) == length else -1
                assert got[at] == expected
                at += 1


def brute(rows, length=50):
    first = {}
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - length + 1):
            w = raw[i:i + length]
            first[w] = min(first.get(w, float("inf")), float("inf") if d is None else d)
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - length + 1):
            if first[raw[i:i + length]] < (float("inf") if d is None else d):
                gone[i:i + length] = True
        kept = bytes(np.frombuffer(raw, dtype=np.uint8)[~gone])
        out.append((d, len(raw), int(gone.sum()), kept))
    return sorted(out, key=repr)


def rows():
    shared = "the very same long passage that repeats in a great many documents of the corpus, again and again"
    out = [(d, t) for d, t, *_ in EDGE if len(t or "") < 5000]
    out += [(100 + i, (f"unique {i} " * 9)[:i * 7] + shared + f" tail {i * i} " * 5) for i in range(120)]
    out += [(500, "ab" * 900), (501, "ab" * 100 + "\0" * 80), (502, "\0" * 90 + "ab" * 60), (None, shared[5:60] + " own"), (503, shared[:49]), (503, shared[:50])]
    return out


@pytest.mark.parametrize("hot", [2048, 0])
def test_removed_bytes_equal_brute_force(spark, hot):
    data = rows()
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = remove_long_repeats(docs, hot=hot).collect()
    assert sorted([(r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), bytes(r.kept)) for r in got], key=repr) == brute(data)
    for r in got:
        assert all(a < b for a, b in zip(r.starts, r.ends, strict=True)) and all(b < a for b, a in zip(r.ends, r.starts[1:], strict=False))
        assert sum(b - a for a, b in zip(r.starts, r.ends, strict=True)) == r.n_bytes - len(r.kept)


def test_a_bucket_is_the_same_in_whatever_order_its_rows_come():
    """Anchors beside the border of two documents depend on both; every step must see them in one order."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdef"), 5)) for _ in range(40)]
    frame = pd.DataFrame({"doc_id": pd.array([*range(60), None, 7], dtype="Int64"),
                          "text": [" ".join(rng.choice(words, int(rng.integers(0, 60)))) for _ in range(60)] + [None, "seven"]})
    def contexts(docs):
        b = _Bucket(docs)
        anchors = np.unique(np.concatenate([h for _, _, _, _, h, _ in b.anchors()]))
        r = _Repeats(b, anchors)
        return r.keys[r.one].tolist(), [[*own] for _, own in r.by_part(5)], b.ids.tolist()
    expected = contexts(frame)
    for seed in range(5):
        assert contexts(frame.sample(frac=1, random_state=seed)) == expected


def test_long_copy_and_empty_table(edge_docs, no_docs):
    got = {r.doc_id: r for r in remove_long_repeats(edge_docs.where("doc_id in (5, 6)")).collect()}
    assert len(got[5].kept) == got[5].n_bytes and len(got[6].kept) == 0 and got[6].starts == [0]
    assert remove_long_repeats(no_docs).count() == 0


def test_rows_of_one_id_with_partly_shared_texts(spark):
    """Rows of one id remove nothing from each other, but each loses what a smaller id holds of it, though their contexts differ.

    Only the bucket that sends a context is told what its strings lose: rows of one id must be dealt together."""
    shared = "a passage of more than fifty bytes that all of these documents hold, whatever their id may be"
    data = [(None, f"{i * 7919} {shared} {i}") for i in range(60)] + [(9, f"{shared} {i * 104729}") for i in range(60)] + [(3, "x" + shared[2:])]
    got = remove_long_repeats(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert sorted([(r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), bytes(r.kept)) for r in got], key=repr) == brute(data)
    assert all(len(r.starts) == 1 for r in got if r.doc_id != 3)


def test_only_suffixes_that_are_not_yet_apart_are_sorted_again(monkeypatch):
    import towerlens.llm.run_index as run_index
    rng, sizes = np.random.default_rng(4), []
    monkeypatch.setattr(run_index.np, "argsort", lambda x, own=np.argsort: (sizes.append(len(x)), own(x))[1])
    shared = bytes(rng.integers(1, 256, 60, dtype=np.uint8))
    texts = [bytes(rng.integers(1, 256, 70, dtype=np.uint8)) for _ in range(200)] + [shared, shared + b"a"]
    index = RunLengthIndex(texts)
    assert sizes[0] == len(index.text) and len(sizes) > 1 and max(sizes[1:]) <= 1000
    rest = [texts[t][len(texts[t]) - n:] for t, n in zip(index.text_of, index.left, strict=True)]
    assert index.suffixes.tolist() == sorted(range(len(rest)), key=lambda i: (rest[i], i))


def test_anchors_that_are_not_wanted_are_left_out():
    rng = np.random.default_rng(5)
    texts = [bytes(rng.integers(97, 123, 400, dtype=np.uint8)).decode() for _ in range(30)]
    bucket = _Bucket(pd.DataFrame({"doc_id": range(30), "text": texts}))
    every = [np.concatenate(x) for x in list(zip(*bucket.anchors(), strict=True))[1:]]
    wanted = np.unique(every[3])[::3]
    few = [np.concatenate(x) for x in list(zip(*bucket.anchors(wanted), strict=True))[1:]]
    assert 0 < len(few[3]) < len(every[3])
    for x, y in zip(few, every, strict=True):
        assert x.tolist() == y[np.isin(every[3], wanted)].tolist()
