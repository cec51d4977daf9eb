import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from towerlens.llm.dac import CHUNK_BITS, Reader, encode, read_token_files, write_token_files
from towerlens.llm.packing import Packer, merge, pack
from towerlens.llm.tokens import PartEncoder

from .conftest import EDGE

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


def direct(path, texts):
    t = Tokenizer.from_file(public_tokenizers.path(path))
    return [np.array(e.ids, dtype="<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", FILES)
def test_parts_encode_like_whole_texts(name):
    random.seed(3)
    letters = "abcXYZ 's't're  \n\n\t.,!?'\"éÉßÿ×²Ωİ中文0123456789<|> ​́ -_@#"
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 80))) for _ in range(1500)]
    texts += ["<|endoftext|> a <|endoftext|>", "  a  b   c ", " \n a\n b \n\n", "", "x" * 5000, "İstanbul Σας é", "don't we'll 'tis"]
    enc = PartEncoder(public_tokenizers.path(name))
    assert [np.frombuffer(b, dtype="<u4").tolist() for b in enc.encode(texts)] == [x.tolist() for x in direct(name, texts)]


@pytest.mark.parametrize("name", FILES)
def test_plain_texts_take_the_model_once_a_pre_token(name, monkeypatch):
    enc, asked = PartEncoder(public_tokenizers.path(name)), []
    monkeypatch.setattr(enc, "_ids", lambda texts: pytest.fail("the whole tokenizer was asked for plain texts"))
    monkeypatch.setattr(enc.memo, "encode", lambda part, own=enc.memo.encode: (asked.append(part), own(part))[1])
    texts = ["Déjà vu, \n\n it's  the SAME\tweek 2024! ", "it's the same  week, déjà", " \n", "", "x" * 300 + " <b>|"]
    got = [np.frombuffer(b, dtype="<u4").tolist() for b in enc.encode(texts + texts[:2])]
    assert got == [x.tolist() for x in direct(name, texts + texts[:2])]
    assert asked and len(asked) == len(set(asked))


def test_memo_keeps_two_generations(monkeypatch):
    import towerlens.llm.tokens as tokens
    monkeypatch.setattr(tokens, "GENERATION", 20)
    enc = PartEncoder(public_tokenizers.path(FILES[1]))
    texts = [f"some words number {i} and more {i * 7}" for i in range(40)]
    for t, ids in zip(texts, direct(FILES[1], texts), strict=True):
        assert enc.encode([t])[0] == ids.tobytes()
    assert len(enc.memo) <= 40 and 0 < len(enc.older) <= 40 and " some" not in enc.older.keys() - enc.memo.keys()


def test_codes_give_any_token():
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 1 << int(rng.integers(1, 32)), int(rng.integers(0, 3000))).astype("<u4") for _ in range(12)]
    reader = Reader(encode([*range(11), None], docs))
    whole = np.concatenate(docs)
    assert reader.bits == CHUNK_BITS and reader.n_ids == len(whole) and reader.doc_nulls[-1] == 1
    for i in rng.integers(0, len(whole), 300):
        assert reader.token(int(i)) == whole[i]
    for n, d in enumerate(docs):
        assert reader.document(n).tolist() == d.tolist()
    for _ in range(50):
        a, b = sorted(rng.integers(0, len(whole) + 1, 2).tolist())
        assert reader.tokens(a, b).tolist() == whole[a:b].tolist()
    with pytest.raises(IndexError):
        reader.token(len(whole))
    with pytest.raises(ValueError):
        Reader(b"other" + b"\0" * 40)


def test_files_round_trip_in_order_of_id(edge_docs, no_docs):
    manifest = write_token_files(edge_docs, public_tokenizers.path(FILES[0]))
    rows = sorted(read_token_files(manifest).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in rows]
    assert ids == sorted((d for d, *_ in EDGE), key=lambda d: -1 if d is None else d)
    expected = {}
    for (d, t, *_), x in zip(EDGE, direct(FILES[0], [t for _, t, *_ in EDGE]), strict=True):
        expected.setdefault(d, []).append([*x.tolist(), 1])
    at = 0
    for r in rows:
        own = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert (r.start, r.n_tokens) == (at, len(own)) and own in expected[r.doc_id]
        at += len(own)
    assert at == sum(len(x) for xs in expected.values() for x in xs)
    assert read_token_files(write_token_files(no_docs, public_tokenizers.path(FILES[0]))).count() == 0


def test_packer_fills_every_emitted_sequence():
    rng = np.random.default_rng(5)
    packer = Packer(64, 4)
    docs = {d: rng.integers(0, 1000, int(rng.integers(1, 200))).astype("<u4") for d in range(300)}
    for d, ids in docs.items():
        packer.add(d, ids)
        assert len(packer.gaps) <= 4
    rest = packer.close()
    assert all(sum(len(p[2]) for p in s) == 64 for s in packer.done) and sum(len(p[2]) for p in rest) < 64
    got = {d: np.zeros(0, dtype="<u4") for d in docs}
    for d, start, ids, total in sorted([p for s in packer.done for p in s] + rest, key=lambda p: (p[0], p[1])):
        assert start == len(got[d]) and total == len(docs[d])
        got[d] = np.concatenate([got[d], ids])
    assert all(got[d].tolist() == docs[d].tolist() for d in docs)
    assert merge([], 64) == ([], [])


@pytest.mark.parametrize("length", [64, 2048])
def test_pack_keeps_each_id_once(edge_docs, no_docs, length):
    rows = pack(edge_docs.repartition(5), public_tokenizers.path(FILES[1]), length=length, open_windows=3).collect()
    total = sum(len(x) + 1 for x in direct(FILES[1], [t for _, t, *_ in EDGE]))
    assert sum(r.length for r in rows) == total and all(len(r.ids) == 4 * r.length for r in rows)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    partial = 0
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= length and at == pieces[0].sequence_tokens
        assert pieces[0].padded_tokens == (at if at & (at - 1) == 0 else length)
        partial += at < length
    assert partial <= 1  # one unfinished sequence in the whole table
    assert pack(no_docs, public_tokenizers.path(FILES[1])).count() == 0


def test_many_tasks_merge_their_leftovers_in_rounds(spark, monkeypatch):
    import towerlens.llm.packing as packing
    monkeypatch.setattr(packing, "FAN_IN", 3)
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("few words "), F.col("id")).alias("text")).repartition(20)
    rows = pack(docs, public_tokenizers.path(FILES[1]), length=16).collect()
    sizes = {}
    for r in rows:
        sizes[r.sequence_id] = sizes.get(r.sequence_id, 0) + r.length
    assert sum(n < 16 for n in sizes.values()) <= 1 and max(sizes.values()) == 16


def test_checksum_of_the_query_is_of_the_ids(spark):
    ids = np.array([1, 2, 70000], dtype="<u4").tobytes()
    got = spark.createDataFrame([(bytearray(ids),)], "b binary").select(F.crc32("b")).first()[0]
    assert got == zlib.crc32(ids)
