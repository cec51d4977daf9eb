"""Percentile rank with ties sharing their average rank (pandas
``rank(pct=True)``): (rank of first tie + (ties - 1) / 2) / N, N = non-NULL
count, NULL input -> NULL rank.

Neither ``percent_rank`` nor ``cume_dist`` is this function (for 1,2,2,5 they
give 0,1/3,1/3,1 and .25,.75,.75,1; the average rank gives .25,.625,.625,1).

The textbook form is one global ``orderBy`` window, i.e. one task holding
every row (the tests keep it as the reference to compare against). Here:

1. rows are aggregated to (value, count), so a hot value collapses map-side;
2. the values are dealt to partitions by range and written once with their
   partition's number (written, so that number cannot change when a task is
   run again);
3. inside each partition a window counts the rows of smaller values;
4. the partitions' totals, one row each, are summed in order and broadcast;
5. rank = (offset + smaller + (count + 1) / 2) / N, one row per distinct value.

The number of partitions is ``parts`` (default: the session's shuffle
partitions) at any size; no value range or bucket is capped.

The ranks come back to the rows without any task meeting a hot value: values
that hold at least 1 in HEAVY of all rows, of which there are at most HEAVY, are
told by a broadcast table. Their rows, and those without a value, take part in
the join with the other values' ranks under keys that match nothing and are
spread by a hash of the row, so that join meets no value above that share, with
or without adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from towerlens import session


#: A value is heavy when it holds at least this share of all rows.
HEAVY = 1024
#: Keys over which rows that need no light rank are spread.
_SPREAD = 1 << 20


def _ranks(df: DataFrame, col: str, out_col: str, parts: int | None) -> DataFrame:
    """(col, out_col, _cnt, _n, _at): distinct non-NULL values with their rank, their rows, all rows, and 0."""
    v = F.col(col)
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.where(v.isNotNull()).groupBy(v.alias(col)).agg(F.count(F.lit(1)).alias("_cnt"))
    # ``_at`` is written, so that it stays a column: as a literal it would fall out of the join's keys
    ranged = counts.repartitionByRange(parts, col).withColumns({"_part": F.spark_partition_id(), "_at": F.lit(0)})
    ranged = session.materialize(ranged, "rank_values")
    smaller = Window.partitionBy("_part").orderBy(col).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_before", F.coalesce(F.sum("_cnt").over(smaller), F.lit(0)))
    totals = ranged.groupBy("_part").agg(F.sum("_cnt").alias("_tot"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_tot").over(earlier), F.lit(0)).alias("_off"),
                            F.sum("_tot").over(Window.partitionBy()).alias("_n"))
    # ``offsets`` has at most ``parts`` rows.
    rank = ((F.col("_off") + F.col("_before")).cast("double")
            + (F.col("_cnt") + F.lit(1)) / F.lit(2.0)) / F.col("_n")
    return local.join(F.broadcast(offsets), "_part").select(v, rank.alias(out_col), "_cnt", "_n", "_at")


def pct_rank_table(df: DataFrame, col: str, out_col: str, parts: int | None = None) -> DataFrame:
    """Distinct non-NULL values of ``col`` with their average-rank percentile."""
    return _ranks(df, col, out_col, parts).select(col, out_col)


def pct_rank_average(df: DataFrame, col: str, out_col: str, parts: int | None = None, among: DataFrame | None = None) -> DataFrame:
    """``df`` plus ``out_col`` = average-rank percentile of ``col`` among the rows of ``among`` (default ``df``; a written
    table with the same values spares computing ``df`` twice)."""
    ranks = _ranks(among or df, col, out_col, parts)
    heavy = F.col("_cnt") * HEAVY >= F.col("_n")
    hot = ranks.where(heavy).select(F.col(col).alias("_hot"), F.col(out_col).alias("_hot_rank"))
    cold = ranks.where(~heavy).select(F.col(col).alias("_cold"), F.col(out_col).alias("_cold_rank"), "_at")
    told = df.join(F.broadcast(hot), F.col(col) == F.col("_hot"), "left")
    needs = F.col(col).isNotNull() & F.col("_hot").isNull()
    told = told.withColumn("_spread", F.when(needs, F.lit(0)).otherwise((1 + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(_SPREAD))).cast("int")))
    both = told.join(cold, (F.col(col) == F.col("_cold")) & (F.col("_spread") == F.col("_at")), "left")
    return both.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("_hot_rank", "_cold_rank").alias(out_col))
