"""Secret scans: patterns find and label secrets, a character network finds what looks like them.

One pass over whole texts finds, for every text, the spans of three patterns
(assignments of named secrets, access keys, long hexadecimal runs) and all candidates:
the values of those spans, and every run of token characters that has a letter
and a digit and lies in none of them. A candidate keeps windows of its
characters and of the context around it; longer candidates have several.

The spans of the patterns are the labelled findings: they and all
other candidates train the network (``char_network``), calibrate it and set its thresholds; nothing is sampled. The distinct windows are dealt
into shards of bounded size by their hash; every shard trains on all of its windows and the shards' parameters are averaged after each pass. Other candidates may be secrets of a kind that no pattern names, so none is
scored by a network that was told it is none: two networks learn from one half of the windows each and score the other half. These
scores, weighted by how often each window occurs in the corpus, are calibrated and set the thresholds:
for each alphabet of characters (hexadecimal, mixed case, other) an even probability, or a lower one where that would find less than
``RECALL`` of the labelled findings. Other candidates that reach it are added as spans of kind
``likely``; spans of the patterns always stay. A form that no pattern names but that many candidates share (host names, say)
counts as ordinary: the scan adds what is rare and looks like the labelled findings.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from towerlens.llm.char_network import BODY, LEFT, RIGHT, WINDOW, CharNetwork, as_codes, fit_calibration
from towerlens.llm.common import small_batches, written

#: Kinds in the order in which spans of one start are listed; the last one is the network's.
KINDS = ("assign", "access", "hex", "likely")

# Patterns of the base kinds (fixed values).
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")

_NAMES = ("passw", "secret", "token", "api")
#: Runs of token characters; access keys and hexadecimal runs lie within one.
_RUN = re.compile(r"[A-Za-z0-9+/_.=~-]{12,}")
_DIGIT, _LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
_EDGE = "._=~-+/"

#: Distinct windows of the commoner label that one task trains on, about.
SHARD = 16_384
#: Passes over all windows; parameters are averaged after each.
PASSES = 4
#: Parameters are averaged, and logits counted, in whole units of these shares, so that no order of rows changes a result.
_UNIT, _GRID = 1 << 30, 1024
#: Logits beyond are counted as this one.
_FAR = 40
#: Probability above which a candidate is likelier a secret than not: no threshold is higher.
EVEN = 0.5
#: Share of labelled findings that a threshold must find.
RECALL = 0.99
#: Labelled findings of an alphabet, below which it shares the common threshold.
ENOUGH = 20
#: Distinct windows of each label that each half needs.
LEAST = 4
#: Bytes of windows in one batch of results.
_OUT_BYTES = 4 << 20

_SCANNED = ("base array<struct<kind:int,start:int,end:int,value:int>>, "
            "candidates array<struct<start:int,end:int,label:int,first:int,windows:int>>, windows binary")
_FOUND = "array<struct<kind:string,start:int,end:int,score:double>>"


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, start of the value) of the patterns' matches, leftmost and without overlap within a kind."""
    out = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        out = [(0, m.start(), m.end(), m.start(2)) for m in _ASSIGN.finditer(text) if m.end() - m.start(2) >= 8]
    for run in _RUN.finditer(text):
        at, end = run.span()
        if end - at >= 16:
            out += [(1, m.start(), m.end(), m.start()) for m in _ACCESS.finditer(text, at, end)]
        if end - at >= 32:
            out += [(2, m.start(), m.end(), m.start()) for m in _HEX.finditer(text, at, end)]
    return sorted(out, key=lambda s: (s[1], s[0], s[2]))


def _windows(text: str, start: int, end: int) -> bytes:
    """Windows of a candidate: BODY characters at a time, with what stands before and after them."""
    out = []
    for at in range(start, end, BODY):
        stop = min(end, at + BODY)
        left, body, right = text[max(0, at - LEFT):at], text[at:stop], text[stop:stop + RIGHT]
        out.append((left.rjust(LEFT, "\0") + body.ljust(BODY, "\0") + right.ljust(RIGHT, "\0")).encode("ascii", "replace"))
    return b"".join(out)


def scan_text(text: str) -> tuple[list, list, bytes]:
    """The base spans of a text, its candidates (start, end, label, first window, windows) and their windows."""
    base = base_spans(text)
    values = sorted({(v, e) for _, _, e, v in base})
    spans = [(s, e, 1) for s, e in values]
    i, reach = 0, 0  # values are sorted by start; ``reach`` is the furthest end of those that start before a run ends
    for run in _RUN.finditer(text):
        s, e = run.span()
        while i < len(values) and values[i][0] < e:
            reach = max(reach, values[i][1])
            i += 1
        if reach > s:
            continue
        word = run.group()
        if word.isalpha() or not _DIGIT.search(word) or not _LETTER.search(word):
            continue
        s, e = s + len(word) - len(word.lstrip(_EDGE)), e - (len(word) - len(word.rstrip(_EDGE)))
        spans.append((s, e, 0))
    candidates, parts, n = [], [], 0
    for s, e, label in spans:
        w = _windows(text, s, e)
        candidates.append((s, e, label, n, len(w) // WINDOW))
        n += len(w) // WINDOW
        parts.append(w)
    return base, candidates, b"".join(parts)


def _scan(schema: pa.Schema, text_at: int):
    def scan(batches):
        for b in batches:
            rows: list = []
            size, first = 0, 0
            for i, t in enumerate(b.column(text_at).to_pylist()):
                rows.append(scan_text(t or ""))
                size += len(rows[-1][2]) + 40 * len(rows[-1][1])
                if size >= _OUT_BYTES or i == b.num_rows - 1:
                    yield _batch(schema, b.slice(first, i + 1 - first).column(0), rows)
                    rows, size, first = [], 0, i + 1
    return scan


def _batch(schema: pa.Schema, ids: pa.Array, rows: list) -> pa.RecordBatch:
    base = [[dict(zip(("kind", "start", "end", "value"), s, strict=True)) for s in r[0]] for r in rows]
    found = [[dict(zip(("start", "end", "label", "first", "windows"), c, strict=True)) for c in r[1]] for r in rows]
    return pa.RecordBatch.from_arrays([ids.cast(schema.field(0).type), pa.array(base, schema.field(1).type), pa.array(found, schema.field(2).type),
                                       pa.array([r[2] for r in rows], pa.binary())], schema=schema)


def _alphabet(windows: np.ndarray) -> np.ndarray:
    """0 where a window's candidate is of hexadecimal characters, 1 where upper and lower case mix, else 2."""
    body = windows[:, LEFT:LEFT + BODY]
    digit, none = (body >= 48) & (body <= 57), body == 0
    small, large = (body >= 97) & (body <= 122), (body >= 65) & (body <= 90)
    hexes = (digit | none | ((body >= 97) & (body <= 102))).all(axis=1)
    return np.where(hexes, 0, np.where(small.any(axis=1) & large.any(axis=1), 1, 2))


def _half(first: np.ndarray) -> np.ndarray:
    """The half of the corpus that a candidate belongs to, by the characters of its first window: copies fall together."""
    return first.astype(np.int64) @ (np.arange(1, WINDOW + 1) ** 2) % 1009 % 2


@dataclass
class SecretModel:
    """Two networks, each fitted on one half, a calibration and one threshold of probability an alphabet."""

    networks: list[CharNetwork]
    slope: float
    shift: float
    thresholds: list[float]

    def likelihood(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -40, 40)))

    def probabilities(self, windows: np.ndarray, half: np.ndarray) -> np.ndarray:
        """Of each window by the network that saw nothing of its half."""
        return self.likelihood(_logits(self.networks, windows, half))


def labelled_windows(scanned: DataFrame) -> DataFrame:
    """(window, label, n): all distinct first windows of candidates, with how often they occur. A window that occurs with
    both labels is a finding."""
    one = scanned.select(F.col("windows").alias("w"), F.explode("candidates").alias("c")).select(
        F.expr(f"substring(w, c.first * {WINDOW} + 1, {WINDOW})").alias("window"), F.col("c.label").alias("label"))
    return one.groupBy("window").agg(F.max("label").alias("label"), F.count(F.lit(1)).alias("n"))


def _with_half(schema: pa.Schema):
    def add(batches):
        for b in batches:
            x = as_codes(b"".join(b.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(_half(x), pa.int32()), pa.array(_alphabet(x), pa.int32())], schema=schema)
    return add


def _shards(windows: DataFrame, counts: dict[tuple[int, int], int], size: int) -> DataFrame:
    """(half, shard, window, label): every window in a shard of its half, by its hash. The rarer label is dealt into fewer parts
    if these would be smaller than ``size`` / 8, and each part then goes to several shards, so that every shard has both."""
    shards = {h: max(1, -(-max(counts[h, 0], counts[h, 1]) // size)) for h in (0, 1)}
    parts = {(h, y): min(shards[h], max(1, counts[h, y] * 8 // size)) for h in (0, 1) for y in (0, 1)}

    def per(value) -> Column:
        return F.expr("CASE " + " ".join(f"WHEN half = {h} AND label = {y} THEN {value(h, y)}" for h in (0, 1) for y in (0, 1)) + " END")
    part = F.pmod(F.xxhash64("window"), per(lambda h, y: f"{parts[h, y]}L"))
    dealt = windows.withColumns({"_part": part, "_parts": per(lambda h, y: f"{parts[h, y]}L"), "_shards": per(lambda h, y: f"{shards[h]}L")})
    return dealt.select("half", "window", "label", F.explode(F.expr("sequence(_part, _shards - 1, _parts)")).alias("shard"))


_STATE = "half int, at int, value long, rows long"


def _train(state: dict[int, np.ndarray], turn: int, passes: int):
    def train(key, table):
        order = np.argsort(np.array(table["window"].to_pylist(), dtype=f"S{WINDOW}"), kind="stable")
        x = as_codes(b"".join(table["window"].to_pylist()))[order]
        y = table["label"].to_numpy()[order]
        half = key[0].as_py()
        net = CharNetwork().restore(state[half]) if state else CharNetwork()
        net.train(x, y, turn, passes, seed=12 + turn)
        value = np.rint(net.state() * _UNIT).astype(np.int64)
        n = len(value)
        return pa.table({"half": pa.array(np.full(n, half), pa.int32()), "at": pa.array(np.arange(n), pa.int32()),
                         "value": pa.array(value), "rows": pa.array(np.ones(n, dtype=np.int64))})
    return train


def _score(networks: list[CharNetwork], schema: pa.Schema):
    def score(batches):
        for b in batches:
            x, half = as_codes(b"".join(b.column(0).to_pylist())), b.column(3).to_numpy(zero_copy_only=False)
            z = np.rint(_logits(networks, x, half) * _GRID).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), b.column(4), pa.array(z)], schema=schema)
    return score


def _logits(networks: list[CharNetwork], windows: np.ndarray, half: np.ndarray) -> np.ndarray:
    """Of each window by the network that saw nothing of its half, in units of 1 in _GRID."""
    z = np.zeros(len(windows))
    for h in (0, 1):
        z[half == h] = networks[1 - h].logits(windows[half == h])
    return np.rint(np.clip(z, -_FAR, _FAR) * _GRID) / _GRID


def fit_model(labelled: DataFrame, recall: float = RECALL, shard: int = SHARD) -> SecretModel | None:
    """The model of all (window, label, n) rows, or None where a half lacks labelled findings or other candidates.

    Every pass is one job over all windows; the driver holds the two networks and, for calibration and thresholds, exact
    counts by logit in units of 1 in _GRID, label and alphabet, whose number does not grow with the rows. Scores of each half
    are those of the other half's network.
    """
    ddl = "window binary, label int, n long, half int, shape int"
    windows = written(labelled.select("window", F.col("label").cast("int"), "n").mapInArrow(_with_half(_arrow_schema(ddl)), ddl), "secret-windows")
    counts = {(h, y): 0 for h in (0, 1) for y in (0, 1)} | {(r["half"], r["label"]): r["count"] for r in windows.groupBy("half", "label").count().collect()}
    if min(counts.values()) < LEAST:
        return None
    shards = written(_shards(windows, counts, shard), "secret-shards")
    state: dict[int, np.ndarray] = {}
    for turn in range(PASSES):
        means = shards.groupBy("half", "shard").applyInArrow(_train(state, turn, PASSES), _STATE).groupBy("half", "at") \
            .agg(F.sum("value").alias("value"), F.sum("rows").alias("rows")).collect()  # the parameters of two networks
        rows = sorted((r["half"], r["at"], r["value"] / r["rows"] / _UNIT) for r in means)
        state = {h: np.array([v for k, _, v in rows if k == h]) for h in (0, 1)}
    networks = [CharNetwork().restore(state[h]) for h in (0, 1)]
    ddl = "label int, n long, shape int, z long"
    scored = windows.mapInArrow(_score(networks, _arrow_schema(ddl)), ddl).groupBy("label", "shape", "z").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("windows"))
    cells = np.array(sorted((r["label"], r["shape"], r["z"], r["n"], r["windows"]) for r in scored.collect()), dtype=np.int64)
    kept, shape, z, weight, many = cells[:, 0], cells[:, 1], cells[:, 2] / _GRID, cells[:, 3].astype(float), cells[:, 4]
    model = SecretModel(networks, *fit_calibration(z, kept, weight), [])
    p = model.likelihood(z)

    def threshold(own: np.ndarray) -> float:
        order = np.argsort(-p[own], kind="stable")
        reached = np.cumsum(many[own][order])
        return min(EVEN, float(p[own][order][np.searchsorted(reached, int(np.ceil(recall * reached[-1])))]))
    common = threshold(kept == 1)
    for k in range(3):
        own = (kept == 1) & (shape == k)
        model.thresholds.append(threshold(own) if many[own].sum() >= ENOUGH else common)
    return model


def _judge(model: SecretModel | None, schema: pa.Schema):
    def judge(batches):
        for b in batches:
            base, candidates, windows = (b.column(i).to_pylist() for i in (1, 2, 3))
            codes = as_codes(b"".join(windows))
            firsts, total = [], 0
            for found, own in zip(candidates, windows, strict=True):
                firsts += [total + c["first"] for c in found for _ in range(c["windows"])]
                total += len(own) // WINDOW
            p = model.probabilities(codes, _half(codes[np.array(firsts, dtype=int)])) if model else None
            shape = _alphabet(codes)
            out, at = [], 0
            for spans, found, own in zip(base, candidates, windows, strict=True):
                score, likely = {}, []
                for c in found if model else ():
                    first = at + c["first"]
                    part = p[first:first + c["windows"]]
                    over = part >= np.array(model.thresholds)[shape[first:first + c["windows"]]]
                    score[c["start"], c["end"]] = float(part.max())
                    if not c["label"] and over.any():
                        likely.append((3, c["start"], c["end"], float(part.max())))
                at += len(own) // WINDOW
                rows = [(s["kind"], s["start"], s["end"], score.get((s["value"], s["end"]))) for s in spans] + likely
                out.append([{"kind": KINDS[k], "start": s, "end": e, "score": v} for k, s, e, v in sorted(rows, key=lambda r: (r[1], r[0], r[2]))])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, schema.field(1).type)], schema=schema)
    return judge


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", recall: float = RECALL, shard: int = SHARD) -> DataFrame:
    """One row for every row of ``docs``: ``key`` and ``findings``, an array of (kind, start, end, score) by start, then
    kind in the order of KINDS; code points, end exclusive.

    Texts are read whole, however long (a candidate of any length is scored by windows over all of it); a null text
    is empty and has no findings. Null and repeated keys, and repeated rows, are rows like any. ``score`` is the calibrated
    probability of the span's value; it is null where too few labelled findings or other candidates exist to fit the
    network, and then only the patterns' spans are found. Equal windows get equal scores. Other columns of ``docs`` are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    narrow = small_batches(docs).select(F.col(key).alias("key"), F.col(text).alias("text"))
    arrow = _arrow_schema(f"key {kind}, {_SCANNED}")
    scanned = written(narrow.mapInArrow(_scan(arrow, 1), f"key {kind}, {_SCANNED}"), "secret-candidates")
    model = fit_model(labelled_windows(scanned), recall, shard)
    result = scanned.mapInArrow(_judge(model, _arrow_schema(f"key {kind}, findings {_FOUND}")), f"key {kind}, findings {_FOUND}")
    return result.select(F.col("key").alias(key), "findings")


def _arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def base_only(findings: str = "findings") -> Column:
    return F.filter(findings, lambda s: s["kind"] != KINDS[-1])


def joined(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(kind: str, findings: str = "findings") -> Column:
    return F.size(F.filter(findings, lambda s: s["kind"] == kind)).cast("long")
