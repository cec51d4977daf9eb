"""Quality by nearest-neighbour voting over latent-semantic vectors.

1. Terms: every text becomes counts of hashed byte trigrams and of shape terms
   (repetition, capitals, punctuation, line and word lengths, in steps), kept
   as one byte a term (logarithmic) and written once; texts are read once.
2. Weights: inverse document frequencies over all documents.
3. Latent space: one pass over all documents sums X'X times a fixed random
   matrix; its Nystroem factors give the leading directions of X'X.
4. Votes: the vectors of at most ``MOST_LABELLED`` labelled rows are broadcast;
   every document's exact cosines with all of them are computed in blocks, and
   its ``NEIGHBOURS`` nearest vote with weights that grow with similarity.

Scale: one write of about a kilobyte a document, no shuffle but of sums of a
fixed size; the broadcast is bounded by ``MOST_LABELLED``.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from towerlens.llm.common import fold, small_batches, written
from towerlens.llm.features import labelled_sample, summed

#: Labelled rows that vote (the bound of the classifier's sample).
MOST_LABELLED = 20_000
NEIGHBOURS = 25
TRIGRAMS = 1024
SHAPES = 64
TERMS = TRIGRAMS + SHAPES
#: Latent directions kept, and columns of the random matrix.
LATENT, SKETCH = 48, 64
#: Documents multiplied at once with all labelled vectors.
BLOCK = 256
#: A neighbour votes with its cosine to this power.
SHARPNESS = 8
#: Bytes of a text handled at once.
SEGMENT = 1 << 20
#: Weight of a shape term against a trigram that is as frequent.
SHAPE_WEIGHT = 6.0

_STEPS = np.array([0.002, 0.01, 0.03, 0.1, 0.2, 0.4, 0.7])


def _shapes(raw: bytes, letters: np.ndarray) -> np.ndarray:
    """Steps of eight rates, one term each (8 steps a rate); an empty text has none."""
    out = np.zeros(SHAPES, dtype=np.uint8)
    words = raw.split()
    if not words:
        return out
    n, chars = len(words), max(1, len(raw))
    lines = raw.split(b"\n")
    upper = int(letters[65:91].sum())
    lower = int(letters[97:123].sum())
    marks = int(letters[33:48].sum() + letters[58:65].sum() + letters[91:97].sum() + letters[123:127].sum())
    rates = [sum(map(eq, words, words[1:])) / n, 1 - len(set(words)) / n if n < 4000 else 1 - len(set(words)) / n * (n / 4000) ** 0.4,
             upper / max(1, upper + lower), marks / chars, 1 - len(set(lines)) / len(lines), int(letters[48:58].sum()) / chars,
             min(1.0, 2 / n), int(letters[33] + letters[35:39].sum() + letters[42] + letters[124]) / n]
    for k, rate in enumerate(rates):
        out[8 * k + int(np.searchsorted(_STEPS, rate, side="right"))] = 255
    return out


def terms(text) -> bytes:
    """One byte a term: 24 log(1 + count) for trigrams, 255 for the shape steps that hold; null is empty."""
    raw = (text if isinstance(text, str) else "").encode("utf-8", "surrogatepass")
    counts, letters = np.zeros(TRIGRAMS, dtype=np.int64), np.zeros(256, dtype=np.int64)
    for at in range(0, len(raw), SEGMENT):
        a = np.frombuffer(raw, dtype=np.uint8, count=min(SEGMENT + 2, len(raw) - at), offset=at)
        letters += np.bincount(a[:SEGMENT], minlength=256)
        w = a.astype(np.uint32)
        if len(w) > 2:
            h = (w[:-2] * np.uint32(0x9E3779B1) + w[1:-1] * np.uint32(0x85EBCA6B) + w[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)
            counts += np.bincount(h >> np.uint32(22), minlength=TRIGRAMS)
    trigrams = np.minimum(255, np.rint(24 * np.log1p(counts))).astype(np.uint8)
    return trigrams.tobytes() + _shapes(raw, letters).tobytes()


def _term_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        b["terms"] = [terms(t) for t in b["text"]]
        yield b.drop(columns="text")


def _matrix(payloads, weights: np.ndarray | None = None) -> np.ndarray:
    """Rows of weighted terms at length one (an empty text stays zero)."""
    x = np.frombuffer(b"".join(payloads), dtype=np.uint8).reshape(-1, TERMS).astype(np.float32)
    if weights is None:
        return x
    x *= weights.astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _blocks(frame: pd.DataFrame, size: int) -> Iterator[pd.DataFrame]:
    for at in range(0, len(frame), size):
        yield frame.iloc[at:at + size]


def latent_basis(table: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Leading directions (terms x LATENT) of X'X over all rows of ``table``, from one pass."""
    omega = np.random.default_rng(17).standard_normal((TERMS, SKETCH)).astype(np.float32)

    def sketch(frame: pd.DataFrame) -> np.ndarray:
        total = np.zeros((TERMS, SKETCH))
        for part in _blocks(frame, 1024):
            x = _matrix(part["terms"], weights)
            total += x.T @ (x @ omega)
        return total.ravel()

    y = summed(table.select("terms"), sketch, TERMS * SKETCH).reshape(TERMS, SKETCH)
    core = omega.T.astype(np.float64) @ y
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    keep = values > max(values.max(), 0) * 1e-10
    if not keep.any():
        return np.zeros((TERMS, LATENT), dtype=np.float32)
    factor = y @ (vectors[:, keep] / np.sqrt(values[keep]))
    left, strength, _ = np.linalg.svd(factor, full_matrices=False)
    basis = np.zeros((TERMS, LATENT), dtype=np.float32)
    basis[:, :min(LATENT, left.shape[1])] = left[:, :LATENT]
    return basis


class Voters:
    """Labelled vectors at length one, and what a vote needs besides."""

    def __init__(self, weights: np.ndarray, basis: np.ndarray, payloads: list[bytes], labels: np.ndarray):
        self.weights, self.basis = weights, basis
        self.prior = float(labels.mean()) if len(labels) else 0.5
        alike: dict[bytes, list[float]] = {}  # rows with the same terms are one voter, in an order of their own
        for p, y in zip(payloads, labels, strict=True):
            alike.setdefault(bytes(p), []).append(float(y))
        own = sorted(alike)
        self.labels = np.array([np.mean(sorted(alike[p])) for p in own])
        self.rows = np.array([len(alike[p]) for p in own], dtype=np.int64)
        self.vectors = np.concatenate([self._project(own[at:at + 1024]) for at in range(0, len(own), 1024)]) \
            if own else np.zeros((0, LATENT), dtype=np.float32)

    def _project(self, payloads) -> np.ndarray:
        v = _matrix(payloads, self.weights) @ self.basis
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    def scores(self, payloads: list[bytes]) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(payloads), self.prior)
        out = []
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(payloads), BLOCK):
            cosine = self._project(payloads[at:at + BLOCK]) @ self.vectors.T
            near = np.sort(np.argpartition(-cosine, k - 1, axis=1)[:, :k], axis=1)
            order = np.argsort(-np.take_along_axis(cosine, near, axis=1), axis=1, kind="stable")
            near = np.take_along_axis(near, order, axis=1)
            # NEIGHBOURS rows vote; of a voter that stands for more rows than are left, so many of its mean label
            rows = self.rows[near]
            votes = np.clip(NEIGHBOURS - (np.cumsum(rows, axis=1) - rows), 0, rows)
            votes = votes * np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** SHARPNESS
            out.append(((votes * self.labels[near]).sum(axis=1) + 0.01 * self.prior) / (votes.sum(axis=1) + 0.01))
        return np.clip(np.concatenate(out), 0, 1) if out else np.zeros(0)


def _vote(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part in _blocks(b, 1024):
                yield part.drop(columns="terms").assign(score=shared.value.scores(list(part["terms"])))
    return run


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1, higher: quality 1 likelier).

    ``labels`` has (doc_id, quality); ``held_out`` is a condition on doc_id, and labels of such rows are never used.
    Null text is empty: an empty text meets no neighbour and gets the share of quality 1 among the labelled rows, as
    does everything when all vectors vanish; without labels the score is 0.5. Repeated rows are scored alike, null
    doc_ids are scored but never labelled. An empty table gives an empty result; other columns are not read.

    Labelled rows with equal terms (copies, say) vote as one with their mean label, weighing as many neighbours as they are; so ties
    among them do not depend on the order of rows. Of rows that share a labelled doc_id, the one with the smallest terms counts.
    Texts are read whole, in segments where they are very long.
    """
    spark = docs.sparkSession
    small_batches(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    table = written(rows.mapInPandas(_term_batches, "doc_id long, held_out boolean, terms binary"), "quality-terms")

    def present(frame: pd.DataFrame) -> np.ndarray:
        return np.append(sum((_matrix(p["terms"]) > 0).sum(axis=0) for p in _blocks(frame, 1024)), len(frame))

    found = summed(table.select("terms"), present, TERMS + 1)
    weights = np.log((found[-1] + 1) / (found[:-1] + 1)) + 0.1
    weights[TRIGRAMS:] *= SHAPE_WEIGHT
    basis = latent_basis(table, weights)
    sample = labelled_sample(labels, "quality", ~F.coalesce(held_out, F.lit(False)), MOST_LABELLED)
    voters = table.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id")).where("NOT held_out") \
        .groupBy("label_id").agg(F.min("terms").alias("terms"), F.first("label").alias("label")).toPandas()  # at most a row of the sample each
    shared = spark.sparkContext.broadcast(Voters(weights, basis, list(voters["terms"]), voters["label"].to_numpy(dtype=np.float64)))
    return table.mapInPandas(_vote(shared), "doc_id long, held_out boolean, score double")


def quarter_held_out() -> Column:
    """Documents whose crc32 of the id leaves 2 modulo 4."""
    return fold() % 4 == 2
