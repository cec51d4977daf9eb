"""Exact distinct counts that can be merged: bitmaps over dense ids.

A distinct count of a month does not follow from those of its days; bitmaps of
the days do give it, without reading the rows again. Ids are numbered without
gaps, cut into buckets of 32,768, and a bucket of a group is one bitmap of 4 KB:

1. ``dense_ids`` numbers the distinct keys (dealt by range, numbered inside each
   partition, shifted by the partitions' totals; no task sees all keys);
2. ``presence`` sets a bit for each id of a group. Its rows, which callers make
   distinct, are dealt by group and bucket first: a bitmap made before the
   shuffle would hold few ids, the fewer the more buckets there are;
3. ``merged`` unites bitmaps into coarser groups, ``counted`` counts their bits.

The bitmaps of a day are written once and later days are added beside them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from towerlens import session


def dense_ids(df: DataFrame, key: str, id_col: str = "dense_id", parts: int | None = None) -> DataFrame:
    """(key, id_col): the distinct non-null keys of ``df`` in ascending order, numbered from 0 without gaps."""
    k = F.col(f"`{key}`")
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = df.where(k.isNotNull()).select(k.alias(key)).distinct()
    # written, so that a key's partition cannot change when a task is run again
    dealt = session.materialize(keys.repartitionByRange(parts, key).withColumn("_part", F.spark_partition_id()), "dense_keys")
    totals = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))  # at most ``parts`` rows
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(key))
    return dealt.withColumn("_at", inside).join(F.broadcast(offsets), "_part") \
        .select(k, (F.col("_off") + F.col("_at") - 1).cast("long").alias(id_col))


def presence(df: DataFrame, by: Sequence[str], id_col: str = "dense_id") -> DataFrame:
    """(by..., bucket, bits): which ids occur in each group; rows without an id are left out, NULL groups are kept."""
    i = F.col(id_col) + 1  # Spark's buckets start at 1
    placed = df.where(F.col(id_col).isNotNull()).select(*by, F.bitmap_bucket_number(i).alias("bucket"), F.bitmap_bit_position(i).alias("_bit"))
    return placed.repartition(*by, "bucket").groupBy(*by, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def merged(bitmaps: DataFrame, by: Sequence) -> DataFrame:
    """Bitmaps of the coarser groups ``by`` (names or expressions over the finer groups' columns)."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(bitmaps: DataFrame, by: Sequence[str], out_col: str) -> DataFrame:
    """Distinct ids of each group; without groups one row, 0 for no bitmaps."""
    n = F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(out_col)
    return bitmaps.groupBy(*by).agg(n) if by else bitmaps.agg(n)
