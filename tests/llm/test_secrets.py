"""Secret scan: base spans against brute force, the network on secrets of other forms, edge rows."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from towerlens.llm import secret_scan as S
from towerlens.llm.char_network import WINDOW, CharNetwork, as_codes, fit_calibration


def brute(text):
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32])


def test_base_spans_equal_brute_force():
    r = random.Random(3)
    bits = ["token", "TOKEN", "api_key", "apikey", "Passwd", "password", "secret", "=", ":", " ", '"', "'", "AKIA", "ABCD1234EFGH", "AKIAAKIA0123456789", "ſecret", "toKen",
            "0123456789abcdef0123456789abcdef", "deadbeef", "x", "é", "\n", "short", "longvalue99", "_.=-", "a" * 40, "😀"]
    for _ in range(4000):
        text = "".join(r.choice(bits) for _ in range(r.randint(1, 14)))
        assert [(s, k, e) for k, s, e, _ in S.base_spans(text)] == brute(text), text


def test_candidates_leave_out_what_a_base_span_covers():
    text = 'say token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" or a1b2c3d4e5f6g7h8, not thisisonlyaword 123456789012'
    base, found, windows = S.scan_text(text)
    assert [b[0] for b in base] == [0, 2] and [(text[s:e], y) for s, e, y, _, _ in found] == [("04dbebab91ab85687d33eeaaf9ac699e1188f962", 1), ("a1b2c3d4e5f6g7h8", 0)]
    assert len(windows) == 3 * WINDOW and as_codes(windows).shape == (3, WINDOW)


def test_long_candidates_are_windowed_whole():
    text = "9" + "ab" * 200_000
    _, found, windows = S.scan_text(text)
    assert found[0][:2] == (0, len(text)) or found[0][1] == len(text)
    assert len(windows) // WINDOW >= len(text) // 32


def test_gradients_are_those_of_the_loss():
    r = np.random.default_rng(1)
    x, y = r.integers(0, 128, (6, WINDOW)), np.array([1, 0, 1, 0, 1, 0])
    net = CharNetwork()

    def loss():
        z = net._forward(x)[4]
        return float(np.mean(np.log1p(np.exp(z)) - y * z))
    grads = net._gradients(x, y.astype(float))
    for name, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        net.p[name][at] += 1e-5
        up = loss()
        net.p[name][at] -= 2e-5
        down = loss()
        net.p[name][at] += 1e-5
        assert abs((up - down) / 2e-5 - g[at]) < 1e-5, name


def test_calibration_recovers_the_probabilities():
    r = np.random.default_rng(2)
    z = r.normal(0, 2, 20_000)
    y = (r.random(20_000) < 1 / (1 + np.exp(-(0.5 * z - 1)))).astype(int)
    a, b = fit_calibration(z, y, np.ones(len(z)))
    assert abs(a - 0.5) < 0.05 and abs(b + 1) < 0.1


def corpus(n=300, seed=4):
    r = random.Random(seed)
    hexes = lambda k: "".join(r.choice("0123456789abcdef") for _ in range(k))
    words = lambda k: " ".join("".join(r.choice("aeioustrnlm") for _ in range(r.randint(2, 9))) for _ in range(k))
    rows = []
    for i in range(n):
        kind = i % 3
        mid = f'token = "{hexes(40)}"' if kind == 0 else f"{words(1)}.{r.randint(10, 99)}@mail{r.randint(0, 9)}.example.com" if kind == 1 else f"report-{r.randint(1, 99)}.final-draft"
        rows.append((i, f"{words(8)} {mid} {words(8)}"))
    return rows, hexes, words


def test_network_adds_secrets_of_other_forms_and_leaves_other_tokens(spark):
    rows, hexes, words = corpus()
    other = [(1000 + i, f"{words(6)} {hexes(30)} {words(6)}") for i in range(2)]  # too short for the patterns
    found = {r.doc_id: r.findings for r in S.find_secrets(spark.createDataFrame(rows + other, "doc_id long, text string").repartition(6)).collect()}
    assert len(found) == 302
    for i, text in rows:
        assert [(f.start, S.KINDS.index(f.kind), f.end) for f in found[i] if f.kind != "likely"] == brute(text)
        assert all(f.score is not None for f in found[i])
    caught = sum(any(f.kind == "likely" for f in found[i]) for i, _ in other)
    wrong = sum(any(f.kind == "likely" for f in found[i]) for i, _ in rows)
    assert caught == 2 and wrong <= 6


def test_every_window_trains(spark):
    """More windows than one shard holds: each is in a shard of its half, every shard has both labels, counts are whole."""
    docs = spark.range(9_000).select(F.col("id").alias("doc_id"), F.concat(F.when(F.col("id") % 30 == 0, F.lit("token = ")).otherwise(F.lit("see ")),
                                     F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 20), F.lit(" end")).alias("text"))
    ddl = f"key long, {S._SCANNED}"
    scanned = docs.mapInArrow(S._scan(S._arrow_schema(ddl), 1), ddl)
    windows = S.labelled_windows(scanned)
    rows = windows.collect()
    zeros = sum(r.label == 0 for r in rows)
    assert zeros > 8_000 and sum(r.n for r in rows if r.label == 1) == 300
    ddl = "window binary, label int, n long, half int, shape int"
    halved = windows.select("window", F.col("label").cast("int"), "n").mapInArrow(S._with_half(S._arrow_schema(ddl)), ddl)
    counts = {(r["half"], r["label"]): r["count"] for r in halved.groupBy("half", "label").count().collect()}
    dealt = S._shards(halved, counts, 1_000).collect()
    assert {(bytes(r.window), r.label) for r in dealt} == {(bytes(r.window), r.label) for r in rows}
    assert sum(r.label == 0 for r in dealt) == zeros
    held = {(r.half, r.shard) for r in dealt}
    assert len(held) > 6 and {(r.half, r.shard, r.label) for r in dealt} == {(*h, y) for h in held for y in (0, 1)}


def test_edge_rows(spark, edge_docs, no_docs):
    rows = S.find_secrets(edge_docs).collect()
    assert len(rows) == edge_docs.count() and all(r.findings == [] for r in rows)
    assert S.find_secrets(no_docs).count() == 0
    few = spark.createDataFrame([(1, "token: abcdefgh12345678"), (1, "token: abcdefgh12345678"), (None, None)], "doc_id long, text string").withColumn("findings", F.lit("clash"))
    got = [[(f.kind, f.start, f.end, f.score) for f in r.findings] for r in S.find_secrets(few).collect()]
    assert sorted(got) == [[], [("assign", 0, 23, None)], [("assign", 0, 23, None)]]
