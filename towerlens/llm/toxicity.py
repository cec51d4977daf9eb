"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

1. Lexicon: of the labelled training rows, words (and word beginnings of four
   and five letters) that are far more frequent in toxic texts, weighed by
   log-odds; a short fixed list of insults comes on top.
2. Features of whole texts: lexicon densities, hits near a second-person
   pronoun, capitals, punctuation, obfuscated spellings.
3. Boosted trees on three of four training folds (Spark ML, on the cluster).
4. Isotonic regression of the labels of the fourth fold on the trees' score.

Scale: features come from one narrow scan; the model is fitted on at most
``MOST_LABELLED`` rows, the calibration on at most 1001 score steps, and the
lexicon has at most ``LEXICON`` terms, so what is broadcast is bounded.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.llm.common import fold, fresh, small_batches, written
from towerlens.llm.features import labelled_sample

#: Labelled rows the model is fitted on (the bound of the classifier's sample).
MOST_LABELLED = 30_000
#: Partitions in which the trees see that sample, at most: it is a few MB of features, more partitions are only more tasks a tree.
MOST_PARTS = 6
LEXICON = 2_000
#: A learned term occurs in so many toxic rows, and with so high a z-score of its log-odds.
LEAST_TOXIC, LEAST_Z = 3, 3.5
TREES, DEPTH = 24, 4
#: Words within which a second-person pronoun counts as near.
NEAR = 6
WINDOW = 20

#: Insults that count whatever the labels say, and second-person pronouns.
INSULTS = frozenset("""asshole bastard bitch clown cretin disgusting dumb dumbass filth freak garbage idiot idiotic imbecile
jerk loser moron pathetic pig scum scumbag shit stupid trash ugly vermin worthless""".split())
SECOND_PERSON = frozenset("""you your yours yourself yourselves u ur youre du dich dir dein deine deiner deinem deinen ihr euch
euer eure tu te toi ton ta tes vous votre vos tú ti usted ustedes tus vosotros vuestro""".split())

_WORD = re.compile(r"[^\W\d_]+")
#: A run of letters with signs or digits among them that may stand for letters.
_MASKED = re.compile(r"(?<![\w@$!*])(?=[\w@$!*.-]{3,40}(?![\w@$!*]))(?:[^\W_]+[@$!*0-9.-]+)+[^\W_]+")
_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None, ".": None, "-": None, "_": None})
_STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
_MARKS_RUN = re.compile(r"[!?]{2,}")

FEATURES = ("log_words", "insult_density", "insult_hits", "learned_density", "learned_hits", "learned_distinct", "beginning_density", "beginning_hits",
            "weight_sum", "weight_max", "weight_mean", "window_hits", "near_second_person", "second_person_density", "capital_letters",
            "capital_words", "capital_hits", "exclamations", "questions", "marks", "mark_runs", "masked", "masked_hits", "stretched")


class Lexicon:
    """Weights of words and of word beginnings (marked by a trailing ``~``)."""

    def __init__(self, terms: dict[str, float]):
        self.words = {t: w for t, w in terms.items() if not t.endswith("~")}
        self.begin4 = {t[:-1]: w for t, w in terms.items() if t.endswith("~") and len(t) == 5}
        self.begin5 = {t[:-1]: w for t, w in terms.items() if t.endswith("~") and len(t) == 6}


def terms_of(text) -> set[str]:
    """Distinct words and word beginnings of a whole text."""
    words = set(_WORD.findall((text if isinstance(text, str) else "").lower()))
    return words.union((w[:4] + "~" for w in words if len(w) > 4), (w[:5] + "~" for w in words if len(w) > 5))


def features(text, lexicon: Lexicon) -> list[float]:
    """Dense features of a whole text, in the order of ``FEATURES``; null is empty."""
    text = text if isinstance(text, str) else ""
    cased = _WORD.findall(text)
    words = [w.lower() for w in cased]
    n, chars = max(1, len(words)), max(1, len(text))
    insults = [i for i, w in enumerate(words) if w in INSULTS]
    known, begin4, begin5 = lexicon.words, lexicon.begin4, lexicon.begin5
    learned = [i for i, w in enumerate(words) if w in known]
    begun = [i for i, w in enumerate(words) if w[:5] in begin5 or w[:4] in begin4] if begin4 or begin5 else []
    hits = sorted({*insults, *learned, *begun})
    weights = [max(known.get(words[i], 0.0), begin5.get(words[i][:5], 0.0), begin4.get(words[i][:4], 0.0), 2.0 if words[i] in INSULTS else 0.0) for i in hits]
    second = np.array([i for i, w in enumerate(words) if w in SECOND_PERSON])
    near = 0
    if len(second) and hits:
        at = np.searchsorted(second, hits)
        before, after = second[np.maximum(at - 1, 0)], second[np.minimum(at, len(second) - 1)]
        near = int((np.minimum(np.abs(before - hits), np.abs(after - hits)) <= NEAR).sum())
    place = np.array(hits, dtype=np.int64)
    window = int((np.searchsorted(place, place + WINDOW) - np.arange(len(place))).max()) if hits else 0
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    shouted = sum(1 for w in cased if len(w) > 1 and w.isupper())
    masked = _MASKED.findall(text) if re.search(r"[@$!*0-9.-]", text) else []
    unmasked = [m.lower().translate(_LEET) for m in masked]
    exclaims, questions = text.count("!"), text.count("?")
    signs = sum(map(text.count, ",.;:!?*#$%&@|/\\\"'()[]{}<>+=~^_-"))
    return [float(np.log1p(len(words))), len(insults) / n, len(insults), len(learned) / n, len(learned), len({words[i] for i in learned}),
            len(begun) / n, len(begun), sum(weights), max(weights, default=0.0), sum(weights) / max(1, len(weights)), window,
            near, len(second) / n, upper / chars, shouted / n, sum(1 for i in hits if cased[i].isupper()), exclaims / n, questions / n,
            signs / chars, len(_MARKS_RUN.findall(text)) / n, len(masked) / n,
            sum(1 for w in unmasked if w in INSULTS or w in known), len(_STRETCHED.findall(text)) / n]


def _term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of each label that hold a term, per task; handed on before the table of terms grows large."""
    toxic, clean = Counter(), Counter()

    def flush() -> Iterator[pd.DataFrame]:
        found = list(toxic.keys() | clean.keys())
        for at in range(0, len(found), 20_000):
            part = found[at:at + 20_000]
            yield pd.DataFrame({"term": part, "toxic": [toxic[t] for t in part], "clean": [clean[t] for t in part]})

    for b in batches:
        for text, label in zip(b["text"], b["label"], strict=True):
            (toxic if label > 0 else clean).update(terms_of(text))
        if len(toxic) + len(clean) > 500_000:
            yield from flush()
            toxic.clear()
            clean.clear()
    yield from flush()


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """From labelled rows (text, label): the terms of highest z-score of smoothed log-odds."""
    sizes = rows.groupBy("label").count().collect()
    n_toxic = sum(r["count"] for r in sizes if r["label"] > 0)
    n_clean = sum(r["count"] for r in sizes) - n_toxic
    if not n_toxic or not n_clean:
        return Lexicon({})
    counts = rows.select("text", "label").mapInPandas(_term_counts, "term string, toxic long, clean long") \
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") >= LEAST_TOXIC)
    toxic, clean = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(toxic / (n_toxic + 0.5 - F.col("toxic"))) - F.log(clean / (n_clean + 0.5 - F.col("clean")))
    z = odds / F.sqrt(1 / toxic + 1 / clean)
    best = counts.select("term", odds.alias("odds"), z.alias("z")).where((F.col("z") >= LEAST_Z) & (F.col("odds") >= 2)) \
        .orderBy(F.desc("z"), "term").limit(LEXICON).collect()
    return Lexicon({r["term"]: float(r["odds"]) for r in best})


def _feature_udf(lexicon):
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def dense(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t, lexicon.value) for t in texts], dtype=object)
    return dense


class ToxicityModel:
    """Fitted lexicon, trees and calibration; ``score`` adds a column to any documents with a text column."""

    def __init__(self, lexicon, trees, steps, constant: float):
        self.lexicon, self.trees, self.steps, self.constant = lexicon, trees, steps, constant

    def score(self, docs: DataFrame) -> tuple[DataFrame, str]:
        """``docs`` with the score (0 to 1) in one more column, whose name is returned."""
        small_batches(docs)
        name = fresh("toxicity", docs.columns)
        if self.trees is None:
            return docs.withColumn(name, F.lit(self.constant)), name
        vector, raw, probability, predicted = (fresh(x, docs.columns) for x in ("features_", "raw_", "probability_", "prediction_"))
        self.trees.setFeaturesCol(vector).setPredictionCol(predicted)
        self.trees.set(self.trees.rawPredictionCol, raw)
        self.trees.set(self.trees.probabilityCol, probability)
        rows = docs.withColumn(vector, array_to_vector(_feature_udf(self.lexicon)("text")))
        plain = vector_to_array(F.col(probability))[1]
        return self.trees.transform(rows).withColumn(name, calibrated(plain, self.steps)).drop(vector, raw, probability, predicted), name


def calibrated(plain: Column, steps: list[tuple[float, float]] | None) -> Column:
    """Piecewise linear through the isotonic steps (score, share), flat beyond them; unchanged without steps."""
    if not steps:
        return plain
    x = F.array(*[F.lit(float(a)) for a, _ in steps])
    y = F.array(*[F.lit(float(b)) for _, b in steps])
    last = len(steps) - 1
    below = F.size(F.filter(x, lambda v: v <= plain))
    low = F.greatest(F.lit(0), F.least(F.lit(last), below - 1))
    high = F.least(F.lit(last), low + 1)
    span = F.get(x, high) - F.get(x, low)
    part = F.when(span > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (plain - F.get(x, low)) / span))).otherwise(F.lit(0.0))
    return F.get(y, low) + part * (F.get(y, high) - F.get(y, low))


def fit(docs: DataFrame, labels: DataFrame, training: Column, calibration: Column) -> ToxicityModel:
    """Fit on the labelled rows of ``docs``; both conditions are on doc_id, ``calibration`` picks the fold of the isotonic step.

    Without labels of both kinds the score is constant: their share, 0 with none. Rows are dealt by the hash of their id
    and ordered before the fit, so the model does not depend on the layout of ``docs``.
    """
    spark = docs.sparkSession
    small_batches(docs)
    sample = labelled_sample(labels, "toxic", F.coalesce(training, F.lit(False)), MOST_LABELLED)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), F.col("doc_id") == F.col("label_id")) \
        .select("label_id", F.coalesce("text", F.lit("")).alias("text"), "label", F.coalesce(calibration, F.lit(False)).alias("calibrates"))
    rows = written(rows, "toxicity-sample")
    kinds = {(r["calibrates"], r["label"] > 0): r["count"] for r in rows.groupBy("calibrates", "label").count().collect()}
    toxic, every = sum(n for (_, t), n in kinds.items() if t), sum(kinds.values())
    if not (kinds.get((False, True)) and kinds.get((False, False))):
        return ToxicityModel(None, None, None, toxic / every if every else 0.0)
    lexicon = spark.sparkContext.broadcast(learn_lexicon(rows.where("NOT calibrates")))
    parts = min(MOST_PARTS, every // 2000 + 1)  # follows the sample alone, never the layout or the cluster
    dense = written(rows.select(array_to_vector(_feature_udf(lexicon)("text")).alias("features"), "label", "calibrates", "label_id",
                                F.xxhash64("text").alias("order")), "toxicity-features")
    # the trees add up numbers row by row: the same rows in the same order, however the documents are laid out
    dense = dense.repartition(parts, "label_id").sortWithinPartitions("label_id", "order")
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7,
                          minInstancesPerNode=2).fit(dense.where("NOT calibrates"))
    steps = None
    if kinds.get((True, True)) and kinds.get((True, False)):
        plain = F.round(vector_to_array("probability")[1], 3)
        binned = trees.transform(dense.where("calibrates")).groupBy(plain.alias("plain")) \
            .agg(F.avg("label").alias("share"), F.count(F.lit(1)).cast("double").alias("rows")).coalesce(1).sortWithinPartitions("plain")
        model = IsotonicRegression(featuresCol="plain", labelCol="share", weightCol="rows").fit(binned)
        steps = list(zip(model.boundaries.toArray().tolist(), model.predictions.toArray().tolist(), strict=True))
    return ToxicityModel(lexicon, trees, steps, toxic / every)


def fifth_held_out(column: str = "doc_id") -> Column:
    """Documents whose crc32 of the id leaves 0 modulo 5."""
    return fold(column) % 5 == 0


def fit_on_folds(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Remainders 1 to 3 fit the lexicon and the trees, 4 the calibration; 0 is never read."""
    return fit(docs, labels, ~fifth_held_out(), fold() % 5 == 4)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1, higher: toxic likelier).

    Null text is empty and scored like any text (no hits); a very long text is read whole, its features are densities and
    counts. Equal texts have equal scores, repeated rows too; null doc_ids are scored but never labelled. An empty table gives an empty result; lang, source and other columns are not read.
    """
    scored, name = fit_on_folds(docs, labels).score(docs.select("doc_id", "text"))
    return scored.select("doc_id", fifth_held_out().alias("held_out"), F.col(name).alias("score"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without documents whose score reaches ``threshold``; all columns as they are."""
    scored, name = fit_on_folds(docs, labels).score(docs)
    return scored.where(F.col(name) < threshold).drop(name)
