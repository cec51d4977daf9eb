import numpy as np
import xxhash
from pyspark.sql import functions as F

from towerlens.llm.components import components
from towerlens.llm.simhash import RADIUS, _masks, drop_near_copies, fingerprint, links, links_in, near_duplicates, roots_of, slice_planes, within

from .conftest import EDGE


def brute_print(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(n=900):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    chains = [base]
    for _ in range(n // 40):
        chains.append(chains[-1] ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)))
    return np.unique(np.concatenate([*chains, rng.integers(0, 2**63, 200, dtype=np.uint64)]))


def brute_roots(prints):
    i, j = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= RADIUS)
    return roots_of(len(prints), i, j)


def test_fingerprints():
    for text in ["", "one", "one two", "One two\tthree", "a b c d e f g" * 30, "é ß 你 好 end", "  x  y  z  "]:
        assert fingerprint(text) == brute_print(text)
    assert fingerprint(None) == 0 and fingerprint(" \n") == 0


def test_bit_sliced_distances():
    prints = near(300)
    planes, valid = slice_planes(prints)
    for q in prints[::17]:
        words = np.arange(planes.shape[1])
        alive, bits = within(planes, valid, np.full(len(words), q), words, RADIUS)
        found = {int(words[a]) * 64 + b for a, m in zip(alive, bits, strict=True) for b in range(64) if int(m) >> b & 1}
        assert found == set(np.flatnonzero(np.bitwise_count(prints ^ q) <= RADIUS).tolist())


def test_buckets_do_not_mix():
    prints = near()
    whole = links_in(prints, np.zeros(len(prints), dtype=np.int64))
    assert whole.tolist() == brute_roots(prints).tolist()
    group = np.arange(len(prints)) // 7
    for g, root in zip(group, links_in(prints, group), strict=True):
        assert group[root] == g


def test_masks_leave_no_pair_out():
    rng = np.random.default_rng(1)
    for level in _masks():
        for _ in range(300):
            diff = 0
            for b in rng.integers(0, 64, 2):
                diff |= 1 << int(b)
            assert any(not diff & m for m in level)


def test_links_connect_what_brute_force_connects(spark, monkeypatch):
    import towerlens.llm.simhash as module
    prints = near()
    expected = brute_roots(prints)
    frame = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long")
    for bucket in (1024, 16):
        monkeypatch.setattr(module, "BUCKET", bucket)
        root = {r.node: r.root for r in components(links(frame), "test").collect()}
        label = np.array([root.get(int(p), int(p)) for p in prints.view(np.int64)])
        assert len(set(zip(label.tolist(), expected.tolist(), strict=True))) == len(set(expected.tolist())) == len(set(label.tolist()))


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)] + [(200, 100 + i) for i in range(50)]
    got = {r.node: r.root for r in components(spark.createDataFrame(path, "a long, b long"), "test").collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[100 + i] == 100 for i in range(50)) and got[200] == 100
    assert components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


def test_edge_rows(edge_docs, no_docs):
    rows = near_duplicates(edge_docs).collect()
    prints = [brute_print(t) for _, t, *_ in EDGE]
    assert sorted(r.fp & (2**64 - 1) for r in rows) == sorted(prints)
    order = brute_roots(np.unique(np.array(prints, dtype=np.uint64)))
    place = {int(p): int(order[i]) for i, p in enumerate(np.unique(np.array(prints, dtype=np.uint64)))}
    least = {}
    for (d, *_), p in zip(EDGE, prints, strict=True):
        if d is not None:
            least[place[p]] = min(d, least.get(place[p], d))
    assert sorted((r.fp & (2**64 - 1), r.component_id) for r in rows) == sorted((p, least[place[p]]) for p in prints)
    left = drop_near_copies(edge_docs)
    assert left.columns == edge_docs.columns and sorted(r.doc_id for r in left.collect()) == sorted(least.values())
    assert near_duplicates(no_docs).count() == 0 and drop_near_copies(no_docs).count() == 0


def test_null_ids_only_still_keep_one_row_of_each_component(spark):
    docs = spark.createDataFrame([(None, "one text here"), (None, "one text here"), (None, "quite another text there")], "doc_id long, text string")
    assert drop_near_copies(docs.withColumn("fp_", F.lit(1))).count() == 2
