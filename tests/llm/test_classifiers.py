import numpy as np
import pytest
from pyspark.sql import functions as F

from towerlens.llm.features import labelled_sample, summed
from towerlens.llm.quality import TERMS, Voters, quality_scores, quarter_held_out, terms
from towerlens.llm.toxicity import FEATURES, Lexicon, calibrated, drop_toxic, features, terms_of, toxicity_scores

from .conftest import EDGE

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def held_out_accuracy(scored, labels, label, threshold):
    rows = scored.where("held_out").join(labels, "doc_id").select("score", label).collect()
    return np.mean([(r.score >= threshold) == (r[label] == 1) for r in rows])


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    scored = toxicity_scores(docs, labels).cache()
    assert scored.count() == docs.count() and scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert held_out_accuracy(scored, labels, "toxic", 0.5) >= 0.93
    clean = scored.join(labels.where("toxic = 0"), "doc_id")
    assert clean.where("score >= 0.5").count() <= 0.03 * clean.count()


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    scored = quality_scores(docs, labels, quarter_held_out()).cache()
    assert scored.count() == docs.count() and scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert held_out_accuracy(scored, labels, "quality", 0.7) >= 0.95


def test_held_out_labels_are_never_learned(tables):
    docs, labels = tables
    turned = labels.withColumn("quality", F.when(quarter_held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality_scores(docs, x, quarter_held_out()).select("doc_id", F.round("score", 6)) for x in (labels, turned))
    assert a.exceptAll(b).count() == 0


def test_votes_equal_brute_force():
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abcde .!"), 200)) for _ in range(120)]
    payloads = [terms(t) for t in texts]
    basis = rng.standard_normal((TERMS, 48)).astype(np.float32)
    labels = rng.integers(0, 2, 90).astype(float)
    voters = Voters(np.ones(TERMS), basis, payloads[:90], labels)
    x = np.array([np.frombuffer(p, dtype=np.uint8) for p in payloads], dtype=float)
    v = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ basis
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    for score, q in zip(voters.scores(payloads[90:]), v[90:], strict=True):
        cosine = v[:90] @ q
        near = np.argsort(-cosine)[:25]
        votes = np.maximum(cosine[near], 0) ** 8
        assert abs(score - ((votes * labels[near]).sum() + 0.01 * labels.mean()) / (votes.sum() + 0.01)) < 1e-4


def test_classifiers_on_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 1), (5, 1, 0), (None, 1, 1), (6, None, None), (8, 0, 1), (8, 0, 0), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for known in (labels, none):
        for scored in (toxicity_scores(edge_docs, known), quality_scores(edge_docs, known, quarter_held_out())):
            assert scored.count() == len(EDGE) and scored.where("score IS NULL OR score < 0 OR score > 1").count() == 0
        assert toxicity_scores(no_docs, known).count() == 0 and quality_scores(no_docs, known, quarter_held_out()).count() == 0
    left = drop_toxic(edge_docs, none)
    assert left.columns == edge_docs.columns and left.count() == len(EDGE)


def test_features():
    lexicon = Lexicon({"grumble": 3.0, "lowei~": 2.5, "vequ~": 2.0})
    at = {n: i for i, n in enumerate(FEATURES)}
    plain = features("a calm text about nothing at all", lexicon)
    assert len(plain) == len(FEATURES) and plain[at["insult_hits"]] == 0 and plain[at["window_hits"]] == 0
    rude = features("YOU are an IDIOT!! you 1d10t, grumble. loweiper vequa", lexicon)
    assert rude[at["insult_hits"]] == 1 and rude[at["learned_hits"]] == 1 and rude[at["beginning_hits"]] == 2
    assert rude[at["masked_hits"]] == 1 and rude[at["near_second_person"]] >= 2 and rude[at["capital_hits"]] == 1
    assert features(None, lexicon) == features("", lexicon)
    assert terms_of("Lowei loweiper") == {"lowei", "loweiper", "lowe~", "lowei~"}


def test_calibration_is_piecewise_linear(spark):
    frame = spark.createDataFrame([(-1.0,), (0.0,), (0.25,), (0.5,), (0.75,), (2.0,)], "p double")
    got = [r[0] for r in frame.select(calibrated(F.col("p"), [(0.0, 0.1), (0.5, 0.3), (1.0, 0.9)])).collect()]
    assert np.allclose(got, [0.1, 0.1, 0.2, 0.3, 0.6, 0.9])


def test_sample_is_bounded_and_sums_are_whole(spark):
    labels = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic"))
    sample = labelled_sample(labels, "toxic", F.col("doc_id") % 5 != 0, 100)
    rows = sample.collect()
    assert len(rows) == 100 and all(r.label_id % 5 for r in rows)
    assert rows == labelled_sample(labels.repartition(7), "toxic", F.col("doc_id") % 5 != 0, 100).collect()
    total = summed(spark.range(0, 5000, 1, 37), lambda b: np.array([b["id"].sum(), len(b)], dtype=float), 2)
    assert total.tolist() == [5000 * 4999 / 2, 5000.0]
    assert summed(spark.range(0), lambda b: np.array([len(b)], dtype=float), 1).tolist() == [0.0]


def test_quality_of_copies_with_mixed_labels_does_not_depend_on_the_layout(spark):
    """200 equal texts, a third of them of quality 1, more than vote: every copy gets the same score, in any order of rows."""
    rows = [(i, "the same text of a few words, again") for i in range(200)] + [(200 + i, f"other words {i} here and there {i * i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(260)], "doc_id long, quality int")
    seen = []
    for layout in (docs, docs.orderBy(F.desc("doc_id")).coalesce(1), docs.repartition(7, F.xxhash64("doc_id", F.lit(5)))):
        got = {r.doc_id: r.score for r in quality_scores(layout, labels, quarter_held_out()).collect()}
        assert len({round(got[i], 9) for i in range(200)}) == 1 and 0.2 < got[0] < 0.45
        seen.append(got[0])
    assert max(seen) - min(seen) < 1e-6  # the basis is a sum of rounded numbers


def test_quality_takes_one_row_of_a_repeated_labelled_id(spark):
    docs = spark.createDataFrame([(1, "a good text"), (1, "another text"), (1, None), (2, "bad words"), (3, "plain")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert quality_scores(docs, labels, F.lit(False)).count() == 5


def test_toxicity_does_not_depend_on_the_layout(tables):
    docs, labels = tables
    scores = [{r.doc_id: r.score for r in toxicity_scores(layout, labels).collect()}
              for layout in (docs, docs.orderBy(F.desc("doc_id")).coalesce(1), docs.repartition(7, F.xxhash64("doc_id", F.lit(5))))]
    for other in scores[1:]:
        assert other.keys() == scores[0].keys()
        assert max(abs(other[k] - v) for k, v in scores[0].items()) < 1e-9


def test_features_equal_brute_force():
    lexicon = Lexicon({"zork": 3.0, "blarg": 2.5, "mumb~": 2.2, "grump~": 2.1})
    calm = ["the river runs past you", "Zork!! u are a blarg", "mumbling grumpily HERE", "so0o sooo id1ot i.d.i.o.t"]
    rng = np.random.default_rng(4)
    for _ in range(60):
        text = " ".join(rng.choice(" ".join(calm).split(), rng.integers(0, 40)))
        got = dict(zip(FEATURES, features(text, lexicon), strict=True))
        words = ["".join(run) for run in _letter_runs(text.lower())]
        weight = {w: max(3.0 * (w == "zork"), 2.5 * (w == "blarg"), 2.2 * w.startswith("mumb"), 2.1 * w.startswith("grump"))
                  for w in words}
        hits = [i for i, w in enumerate(words) if weight[w] > 0]
        second = [i for i, w in enumerate(words) if w in ("you", "u")]
        assert got["weight_sum"] == pytest.approx(sum(weight[words[i]] for i in hits))
        assert got["near_second_person"] == sum(any(abs(i - j) <= 6 for j in second) for i in hits)
        assert got["window_hits"] == max((sum(i <= j < i + 20 for j in hits) for i in hits), default=0)
        assert got["learned_hits"] == sum(w in ("zork", "blarg") for w in words)
        assert got["exclamations"] == pytest.approx(text.count("!") / max(1, len(words)))


def _letter_runs(text):
    run = []
    for c in text + " ":
        if c.isalpha():
            run.append(c)
        elif run:
            yield run
            run = []
