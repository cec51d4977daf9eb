import hashlib
import os
import random

from towerlens.llm.exact_dedup import CuckooIndex, drop_exact_copies, exact_groups

from .conftest import EDGE


def test_index_is_a_dictionary_under_insert_delete_and_growth():
    random.seed(1)
    index, expected = CuckooIndex(), {}
    for n in range(20_000):
        key = hashlib.sha256(os.urandom(1) + bytes([n % 97])).digest()
        if key in expected and random.random() < 0.5:
            del expected[key]
            assert index.delete(key)
        elif key not in expected:
            expected[key] = n
            index.insert(key, n)
    assert dict(index.items()) == expected and index.size == len(expected)
    assert index.get(b"\x00" * 32) is None and not index.delete(b"\x00" * 32)


def test_a_filter_hit_of_another_key_is_no_match():
    index = CuckooIndex()
    key = hashlib.sha256(b"a").digest()
    index.insert(key, 1)
    twin = key[:10] + b"\x01" * 22  # same buckets, same fingerprint
    assert index.get(twin) is None
    index.insert(twin, 2)
    assert index.get(key) == 1 and index.get(twin) == 2


def brute(rows):
    groups = {}
    for doc, text, *_ in rows:
        groups.setdefault((text or "").encode().lower(), []).append(doc)
    out = []
    for doc, text, *_ in rows:
        raw = (text or "").encode().lower()
        own = groups[raw]
        keep = max([x for x in own if x is not None], default=None)
        out.append((doc, keep, len(own), doc == keep, hashlib.sha256(raw).hexdigest()))
    return out


def test_groups_equal_brute_force(edge_docs, no_docs):
    order = lambda rows: sorted(map(tuple, rows), key=repr)
    assert order(exact_groups(edge_docs).collect()) == order(brute(EDGE))
    assert exact_groups(no_docs).collect() == []


def test_one_row_of_each_group_stays_with_its_columns(edge_docs, no_docs):
    left = drop_exact_copies(edge_docs)
    assert left.columns == edge_docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({keep for _, keep, *_ in brute(EDGE)})
    assert drop_exact_copies(no_docs).count() == 0
