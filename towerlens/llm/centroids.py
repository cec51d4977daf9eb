"""Centroid clustering: Lloyd rounds sharded by dimension.

Vectors are cut into column blocks; a table of shards, bucketed by (block,
chunk), holds for every block the components of some vectors in those columns
only. A round:

1. column-block tasks compute the exact squared distances of their columns to
   their slice of the centroids, one matrix a chunk of rows;
2. the matrices of a chunk are added over blocks (a reduce by chunk, one matrix
   a block) and the nearest centroid of every row is taken;
3. the assignments go back to the shards, joined by (block, chunk) where the
   shards lie; each shard sums its own columns by centroid, and the sums of a
   shard give its new slice.

No task holds more than a block's columns of the vectors and of the
centroids; the driver holds the centroids (``k`` times the width) and no row.
Distances are whole numbers, so the sum over blocks does not depend on order.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from towerlens.llm.common import bucketed, finite, forget, whole_numbers, written

#: Rows of a chunk: what one matrix of partial distances covers.
CHUNK = 1024
#: Components are held within this bound, so that distances of vectors up to 1024 long fit 64 bits.
BOUND = 1 << 25


@dataclass
class Clusters:
    """``rows``: key, ``cluster`` and ``distance`` (squared); ``centroids``: whole numbers; ``totals``: distance by cluster."""

    rows: DataFrame
    centroids: list[list[int]]
    totals: dict[int, int]


def _cut(blocks: list[tuple[int, int]], width: int):
    """Chunks of rows, one record for every block of columns; the first block's record carries the ids too."""
    def cut(batches):
        chunk = TaskContext.get().partitionId() << 32
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                part = b.slice(at, CHUNK)
                values = part.column("x").flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(-1, width)
                ids = part.column("id")
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array(range(len(blocks)), pa.int32()), "chunk": pa.array([chunk] * len(blocks), pa.int64()),
                    "ids": pa.array([ids.to_pylist()] + [None] * (len(blocks) - 1), pa.list_(pa.int64())),
                    "x": pa.array([np.ascontiguousarray(values[:, a:z]).tobytes() for a, z in blocks], pa.binary())})
                chunk += 1
    return cut


def _partial_distances(slices: list[np.ndarray]):
    """A chunk's distances in one block of columns, to that block's slice of the centroids."""
    def measure(batches):
        for b in batches:
            found = []
            for block, x in zip(b.column("block").to_pylist(), b.column("x").to_pylist(), strict=True):
                centre = slices[block]
                part = np.frombuffer(x, dtype="<i4").astype(np.int64).reshape(-1, centre.shape[1])
                far = np.zeros((len(part), len(centre)), dtype="<i8")
                for j in range(centre.shape[1]):
                    step = part[:, j, None] - centre[None, :, j]
                    far += step * step
                # four bytes a number where they hold them
                found.append((far.astype("<u4") if not far.size or far.max() < 1 << 32 else far).tobytes())
            yield pa.RecordBatch.from_pydict({"chunk": b.column("chunk"), "rows": pa.array(
                [len(x) // (4 * slices[k].shape[1]) for k, x in zip(b.column("block").to_pylist(), b.column("x").to_pylist(), strict=True)], pa.int32()),
                "far": pa.array(found, pa.binary())})
    return measure


def _nearest(k: int):
    def reduce(key: tuple[pa.Scalar, ...], parts: pa.Table) -> pa.Table:
        total = None
        for rows, far in zip(parts["rows"].to_pylist(), parts["far"].to_pylist(), strict=True):
            matrix = np.frombuffer(far, dtype="<u4" if len(far) == 4 * rows * k else "<i8").reshape(rows, k).astype(np.int64)
            total = matrix if total is None else total + matrix
        best = total.argmin(axis=1)  # of equal distances the smaller number
        far = total[np.arange(len(total)), best]
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int64()), "cluster": pa.array([best.tolist()], pa.list_(pa.int32())),
                         "distance": pa.array([far.tolist()], pa.list_(pa.int64()))})
    return reduce


def _block_sums(widths: list[int], k: int):
    """Sums of a task's rows by (block, cluster): at most blocks times k rows a task, whatever it reads."""
    def add(batches):
        sums = [np.zeros((k, w), dtype=np.int64) for w in widths]
        counts = [np.zeros(k, dtype=np.int64) for _ in widths]
        for b in batches:
            for block, x, cluster in zip(b.column("block").to_pylist(), b.column("x").to_pylist(), b.column("cluster"), strict=True):
                label = cluster.values.to_numpy()
                np.add.at(sums[block], label, np.frombuffer(x, dtype="<i4").astype(np.int64).reshape(-1, widths[block]))
                counts[block] += np.bincount(label, minlength=k)
        at = [(b, c) for b in range(len(widths)) for c in range(k) if counts[b][c]]
        yield pa.RecordBatch.from_pydict({
            "block": pa.array([b for b, _ in at], pa.int32()), "cluster": pa.array([c for _, c in at], pa.int32()),
            "n": pa.array([int(counts[b][c]) for b, c in at], pa.int64()),
            "sums": pa.array([sums[b][c].tolist() for b, c in at], pa.list_(pa.int64()))})
    return add


def hash_order(seed: str, key: str = "vec_id") -> Column:
    """Order of starting vectors: hex SHA-256 of ``seed`` and the key in decimal; a null key counts as an empty text."""
    return F.sha2(F.concat(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)


def cluster_vectors(vectors: DataFrame, order: Column, vec: str = "embedding", key: str = "vec_id", width: int = 64, k: int = 16,
                    rounds: int = 3, scale: int = 64, blocks: int = 4) -> Clusters:
    """Lloyd rounds over the vectors of exactly ``width`` finite components, each floor(scale * x); others are dropped.

    The ``k`` first vectors by ``order`` (of equal ones the smaller key, nulls last, then the smaller components) are the
    starting centroids; fewer vectors give fewer centroids. Each of ``rounds`` assigns every vector to the nearest centroid (ties: the
    smaller number) and replaces every centroid that has vectors by floor(sum / count); a last assignment follows. Null keys
    and rows that share a key are rows like any. Components beyond 2**25 after scaling are held there. An empty table gives no rows. Of
    the columns of ``vectors`` only key and vector are read.
    """
    spark = vectors.sparkSession
    kept = vectors.where(finite(vec) & (F.size(vec) == width)).select(
        F.col(key).cast("long").alias("id"), whole_numbers(vec, scale, BOUND).alias("x"), order.alias("rank"))
    centres = np.array([r[0] for r in kept.orderBy("rank", F.col("id").asc_nulls_last(), "x").select("x").limit(k).collect()], dtype=np.int64)
    if not len(centres):
        return Clusters(kept.select(F.col("id").alias(key), F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance")), [], {})
    k = len(centres)
    cuts = [(a, min(width, a + -(-width // blocks))) for a in range(0, width, -(-width // blocks))]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    records = kept.select("id", "x").mapInArrow(_cut(cuts, width), "block int, chunk long, ids array<long>, x binary")
    shards, name = bucketed(records.repartition(buckets, "block", "chunk"), "shards", buckets, "block", "chunk")

    def assigned() -> DataFrame:
        far = shards.select("block", "chunk", "x").mapInArrow(_partial_distances([centres[:, a:z] for a, z in cuts]), "chunk long, rows int, far binary")
        return written(far.groupBy("chunk").applyInArrow(_nearest(k), "chunk long, cluster array<int>, distance array<long>"), "nearest")

    def updated(nearest: DataFrame) -> np.ndarray:
        back = nearest.select("chunk", "cluster", F.explode(F.array(*[F.lit(b) for b in range(len(cuts))])).alias("block"))
        sums = shards.select("block", "chunk", "x").join(back, ["block", "chunk"]).select("block", "x", "cluster") \
            .mapInArrow(_block_sums([z - a for a, z in cuts], k), "block int, cluster int, n long, sums array<long>")
        one = sums.select("block", "cluster", "n", F.posexplode("sums").alias("at", "s")).groupBy("block", "cluster", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        # floor division of whole numbers; one row a component of a centroid
        rows = one.select("block", "cluster", "at", F.expr("(s - pmod(s, n)) div n").alias("value")).collect()
        new = centres.copy()
        for r in rows:
            new[r["cluster"], cuts[r["block"]][0] + r["at"]] = r["value"]
        return new

    for _ in range(rounds):
        centres = updated(assigned())
    nearest = assigned()
    totals = nearest.select(F.inline(F.arrays_zip("cluster", "distance"))).groupBy("cluster").agg(F.sum("distance").alias("total")).collect()
    ids = shards.where("block = 0").select("chunk", "ids")
    rows = ids.join(nearest, "chunk").select(F.inline(F.arrays_zip(F.col("ids").alias(key), "cluster", "distance")))
    rows = written(rows.toDF(key, "cluster", "distance"), "clusters")
    forget(spark, name)
    return Clusters(rows, centres.tolist(), {r["cluster"]: r["total"] for r in totals})


def with_totals(found: Clusters) -> DataFrame:
    """Every row with the distances summed over its cluster and over all, and the SHA-256 of its centroid's components
    (decimal, comma-joined). What is joined has one row a centroid."""
    spark = found.rows.sparkSession
    every = sum(found.totals.values())
    of = [(c, t, every, hashlib.sha256(",".join(map(str, found.centroids[c])).encode()).hexdigest()) for c, t in found.totals.items()]
    totals = spark.createDataFrame(of, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.rows.join(F.broadcast(totals), "cluster")
