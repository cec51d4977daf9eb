"""Operators over embeddings against brute force, and where their rows travel."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from towerlens.llm import vector_codes as V
from towerlens.llm.centroids import cluster_vectors, hash_order, with_totals
from towerlens.llm.common import add_total, bucketed, forget
from towerlens.llm.queries import QUERIES


def nearest(x, c):
    d = ((x[:, None] - c[None]) ** 2).sum(2)
    return d.argmin(1), d.min(1)


def lloyd(x, c, rounds):
    c = c.copy()
    for _ in range(rounds):
        a, _ = nearest(x, c)
        for k in range(len(c)):
            if (a == k).any():
                c[k] = [int(t) // int((a == k).sum()) for t in x[a == k].sum(0)]
    return (c, *nearest(x, c))


def vectors(spark, n=300, width=16, seed=5):
    r = np.random.default_rng(seed)
    rows = [(i * 3, [float(v) for v in r.normal(0, 0.2, width).astype("f4")], i % 3 or None) for i in range(n)]
    rows += [(7, list(rows[4][1]), 1)] * 150  # a third of all rows are copies of one vector, of one key
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), rows


def brute_codes(rows, parts=8, entries=16, rounds=6):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    x = np.floor(np.array([r[1] for r in rows], dtype="f8") * 4096).astype(int)
    w = x.shape[1] // parts
    found = [lloyd(x[:, p * w:(p + 1) * w], x[:entries, p * w:(p + 1) * w], rounds) for p in range(parts)]
    codes = np.array([a for _, a, _ in found]).T
    return [c.tolist() for c, _, _ in found], sorted(zip([r[0] for r in rows], codes.tolist(), sum(f for _, _, f in found).tolist(), strict=True), key=str)


@pytest.mark.parametrize("owner_rows", [50_000, 40])
def test_codes_equal_brute_force_with_a_hot_vector_and_split_owners(spark, owner_rows):
    df, rows = vectors(spark)
    books, want = brute_codes(rows)
    found = V.encode_vectors(df.repartition(5), owner_rows=owner_rows)
    assert found.codebooks == books
    assert sorted(((r.vec_id, list(r.codes), r.error) for r in found.rows.collect()), key=str) == want


def test_owners_work_without_an_exchange(spark):
    df = spark.range(1000).select(F.col("id").alias("row"), (F.col("id") % 8).cast("int").alias("position"), (F.col("id") % 5).cast("int").alias("home"),
                                  F.lit(0).alias("salt"), F.array(F.lit(1), F.lit(2)).alias("part"))
    table, name = bucketed(df.repartition(8, *V._KEYS), "members", 8, *V._KEYS)
    own = V._by_owner([table, table], V._reassign(np.zeros((8, 5, 2), dtype=np.int64)), "row long, position int, home int, salt int, part array<int>, entry int, moved int")
    assert "Exchange" not in own._jdf.queryExecution().executedPlan().toString() and own.count() == 2000
    sums = table.groupBy(*V._KEYS).agg(F.sum(F.col("part")[0]))
    assert "Exchange" not in sums._jdf.queryExecution().executedPlan().toString()
    forget(spark, name)


def test_clusters_equal_brute_force(spark):
    df, rows = vectors(spark, width=64)
    rows = sorted(rows, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[0]))
    x = np.floor(np.array([r[1] for r in rows], dtype="f8") * 64).astype(int)
    centres, label, far = lloyd(x, x[:16], 3)
    found = cluster_vectors(df.repartition(7), hash_order("1:"))
    assert found.centroids == centres.tolist()
    got = with_totals(found).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == sorted(zip([r[0] for r in rows], label.tolist(), far.tolist(), strict=True))
    for r in got:
        assert r.inertia == far.sum() and r.cluster_inertia == far[label == r.cluster].sum()
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()


def test_totals_of_hot_null_and_rare_keys(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3000).alias("label"), F.col("id").alias("error"))
    got = add_total(df, "label", "error", "t").collect()
    want: dict = {}
    for r in df.collect():
        want[r.label] = want.get(r.label, 0) + r.error
    assert len(got) == 5000 and all(r.t == want[r.label] for r in got)


BAD = [(None, [0.5] * 64, 1), (None, [0.25] * 64, None), (1, None, 2), (2, [0.5, None] * 32, 2), (3, [float("nan")] * 64, 2), (4, [float("inf")] * 64, None),
       (5, [], 1), (6, [0.1] * 63, 1), (8, [1e30] * 64, 1), (8, [1e30] * 64, 1), (9, [-0.001] * 64, 3)]


def test_vectors_that_are_broken_or_odd(spark):
    df = spark.createDataFrame(BAD, "vec_id long, embedding array<double>, label int")
    for c in ("codes", "error", "row", "position", "cluster", "ids", "x", "rank"):
        df = df.withColumn(c, F.lit("clash"))
    coded = V.encode_vectors(df, keep=("label",)).rows.collect()
    assert sorted(str(r.vec_id) for r in coded) == ["8", "8", "9", "None", "None"] and all(r.error >= 0 for r in coded)
    clustered = with_totals(cluster_vectors(df, hash_order("1:"))).collect()
    assert sorted(str(r.vec_id) for r in clustered) == ["8", "8", "9", "None", "None"]
    for bad in (df.limit(0), df.where("vec_id = 1"), df.where("vec_id = 5")):
        assert V.encode_vectors(bad).rows.count() == 0 and with_totals(cluster_vectors(bad, hash_order("1:"))).count() == 0


def test_queries_keep_their_columns_when_nothing_is_kept(spark, scratch):
    spark.createDataFrame(BAD[2:3], "vec_id long, embedding array<float>, label int").write.parquet(f"{scratch}/embeddings.parquet")
    for name in ("op11_member_resident_codes", "op13_dimension_sharded_lloyd"):
        assert QUERIES[name](spark, scratch).count() == 0
