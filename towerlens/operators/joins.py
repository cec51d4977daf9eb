"""Joins against dimension tables and referential-integrity measures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens import session

#: A key is heavy when it holds at least this share of the fact rows: there are at most as many heavy keys.
HEAVY = 1024
#: Parts over which the rows of a heavy key are spread.
SALTS = 64
#: Unknown keys that are broadcast at most.
TOLD = 1 << 18


def join_dim(fact: DataFrame, dim: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Fact-to-dimension equi-join.

    No hint: Spark broadcasts the dimension when its estimated or measured
    size in bytes is under ``spark.sql.autoBroadcastJoinThreshold``, and
    otherwise shuffles both sides, where AQE splits skewed keys.
    """
    return fact.join(dim, on=on, how=how)


def match_rates(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str,
                out_col: str) -> DataFrame:
    """One row: matched rows, total rows and the share (percent) of ``fact``
    rows whose key exists in ``dim``.

    The fact side is first reduced to (key, rows) with a map-side partial
    aggregate, so the join shuffles one row per key and map task, never the
    raw rows of a hot key. Keys of ``dim`` are de-duplicated before joining.
    """
    per_key = fact.groupBy(F.col(fact_key).alias("_k")).agg(F.count(F.lit(1)).alias("_rows"))
    keys = dim.select(F.col(dim_key).alias("_k")).where(F.col("_k").isNotNull()).distinct() \
        .withColumn("_hit", F.lit(1))
    joined = per_key.join(keys, "_k", "left")
    matched = F.coalesce(F.sum(F.when(F.col("_hit") == 1, F.col("_rows"))), F.lit(0))
    total = F.coalesce(F.sum("_rows"), F.lit(0))
    return joined.agg(matched.alias("matched_rows"), total.alias("total_rows")).select(
        "matched_rows", "total_rows",
        (F.try_divide(F.col("matched_rows").cast("double"), F.col("total_rows")) * 100).alias(out_col))


def key_census(fact: DataFrame, keys: dict[str, DataFrame | None]) -> DataFrame:
    """One row with ``<key>_distinct`` (non-null values of that column of ``fact``), ``<key>_rows``, ``<key>_matched`` and
    ``<key>_match_pct`` (rows whose value the dimension given for the key has in a column of that name; none without one).

    One scan of the key columns serves all of them: every row gives a (key, value) pair a key, which is counted before the
    shuffle, so a hot value is one row per map task. Values are compared as text; NULLs match nothing and count as rows.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(keys)])
    counted = fact.select(F.explode(pairs).alias("_x")).groupBy(F.col("_x.kind").alias("_kind"), F.col("_x.value").alias("_value")) \
        .agg(F.count(F.lit(1)).alias("_rows"))
    known = [dim.select(F.lit(i).alias("_kind"), F.col(f"`{c}`").cast("string").alias("_value")).dropna()
             for i, (c, dim) in enumerate(keys.items()) if dim is not None]
    if known:
        hit = reduce(DataFrame.unionByName, known).distinct().withColumn("_hit", F.lit(True))
        counted = counted.join(hit, ["_kind", "_value"], "left")
    else:
        counted = counted.withColumn("_hit", F.lit(None).cast("boolean"))
    sums = []
    for i, c in enumerate(keys):
        own = F.col("_kind") == i
        sums += [F.count_if(own & F.col("_value").isNotNull()).alias(f"{c}_distinct"),
                 F.coalesce(F.sum(F.when(own, F.col("_rows"))), F.lit(0)).alias(f"{c}_rows"),
                 F.coalesce(F.sum(F.when(own & F.col("_hit"), F.col("_rows"))), F.lit(0)).alias(f"{c}_matched")]
    return counted.agg(*sums).select("*", *[
        (F.try_divide(F.col(f"`{c}_matched`").cast("double"), F.col(f"`{c}_rows`")) * 100).alias(f"{c}_match_pct") for c in keys])


def heavy_keys(fact: DataFrame, key: str) -> DataFrame:
    """(key) of the at most HEAVY non-null keys that hold at least 1 in HEAVY of the keyed rows of ``fact``."""
    k = F.col(f"`{key}`")
    counted = fact.where(k.isNotNull()).groupBy(k.alias(key)).agg(F.count(F.lit(1)).alias("_n"))
    every = counted.agg(F.sum("_n")).scalar()
    return counted.where(F.col("_n") * HEAVY >= every).select(F.col(f"`{key}`"))


def _unused(name: str, *tables: DataFrame) -> str:
    taken = {c.lower() for t in tables for c in t.columns}
    while name in taken:
        name += "_"
    return name


def join_skewed(fact: DataFrame, dim: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``fact`` joined with ``dim`` on ``key`` (inner, left, left_semi, left_anti) such that no task meets a hot key, with or
    without adaptive execution.

    Fact rows of a heavy key are dealt over SALTS parts, and the rows of ``dim`` are repeated for those keys only (at most
    HEAVY of them, told by broadcast). Null keys match nothing and are dealt the same way. The part of a row is a hash of its map
    task and its columns, so a task that is run again deals its rows as before, whatever their order. The heavy keys cost one
    more scan of the key column, aggregated before its shuffle.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join_skewed does not support {how}")
    hot, salt = _unused("_hot", fact, dim), _unused("_salt", fact, dim)
    heavy = F.broadcast(heavy_keys(fact, key).select(F.col(f"`{key}`").alias(hot)))
    k = F.col(f"`{key}`")
    plain = [F.col(f"`{f.name}`") for f in fact.schema.fields if isinstance(f.dataType, T.AtomicType)]
    part = 1 + F.pmod(F.xxhash64(F.spark_partition_id(), *plain), F.lit(SALTS))
    spread = F.when(F.col(hot).isNotNull() | k.isNull(), part).otherwise(F.lit(0).cast("long"))
    left = fact.join(heavy, k == F.col(hot), "left").withColumn(salt, spread).drop(hot)
    copies = F.when(F.col(hot).isNotNull(), F.sequence(F.lit(1).cast("long"), F.lit(SALTS).cast("long"))) \
        .otherwise(F.array(F.lit(0).cast("long")))
    right = dim.where(k.isNotNull()).join(heavy, k == F.col(hot), "left").withColumn(salt, F.explode(copies)).drop(hot)
    return left.join(right, [key, salt], how).drop(salt)


def orphans(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Rows of ``fact`` whose key has no match in ``dim`` (NULL keys included: they match nothing).

    The distinct keys of ``fact``, aggregated before their shuffle, meet the keys of ``dim``; the unknown ones are written once
    and only then meet the rows: by broadcast, so these are not shuffled, or, if they are more than TOLD, by a shuffle that deals the
    rows of hot keys over many tasks.
    """
    key = F.col(f"`{fact_key}`")
    known = dim.select(F.col(f"`{dim_key}`").alias(fact_key)).where(key.isNotNull()).distinct()
    unknown = session.materialize(fact.select(key).where(key.isNotNull()).distinct().join(known, fact_key, "left_anti"), "unknown_keys")
    keyed = fact.where(key.isNotNull())
    few = unknown.count() <= TOLD
    rows = keyed.join(F.broadcast(unknown), fact_key, "left_semi") if few else join_skewed(keyed, unknown, fact_key, "left_semi")
    rows = rows.unionByName(fact.where(key.isNull()))
    return rows.select(*[F.col(f"`{c}`") for c in fact.columns])
