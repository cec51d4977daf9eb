"""Generic operators: dedup, outlier filter, average-rank percentile, joins,
profiles and constraints (unit edge rows and properties)."""

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from towerlens.operators import (
    DataQualityError,
    constraint_violations,
    dedup_counts,
    dedup_keep_first,
    enforce,
    join_dim,
    match_rates,
    null_counts,
    orphans,
    outlier_filter,
    pct_rank_average,
    table_fingerprint,
    value_counts,
)
from towerlens.operators.constraints import TableConstraints


def test_dedup_keeps_first_by_declared_order(spark):
    rows = [("a", 3, "late"), ("a", 1, "first"), ("a", 2, "mid"), ("b", 5, "only"), (None, 2, "n2"), (None, 1, "n1")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    got = {r.k: (r.o, r.v) for r in dedup_keep_first(df, ["k"], ["o"]).collect()}
    assert got == {"a": (1, "first"), "b": (5, "only"), None: (1, "n1")}
    dropped = dedup_keep_first(df, ["k"], ["o"], drop_order_cols=True)
    assert dropped.columns == ["k", "v"]


def test_dedup_with_a_hot_key_sorts_and_shuffles_no_wide_rows(spark):
    # one key holding most rows: ordered by an aggregate before the shuffle; the result is the written table without the copies
    from towerlens.operators.dedup import first_rows
    df = spark.range(20000).select(F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(
        F.col("id").cast("string")).alias("k"), F.col("id").alias("o"), F.lit("wide").alias("w"), F.col("id").alias("_v"))
    out = dedup_keep_first(df, ["k"], ["o"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "hashpartitioning" not in plan and "Aggregate" not in plan and "BroadcastHashJoin" in plan
    assert out.where("k = 'hot'").first().o == 1 and out.count() == 6668
    narrow = df.select("k", "o", F.lit(0).alias("_tie"), F.col("id" if "id" in df.columns else "_v").alias("_row"))
    assert "partial_min" in first_rows(narrow, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    pruned = out.select("o")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o:bigint,_row:bigint>" in pruned


def test_dedup_ties_do_not_depend_on_the_layout(spark):
    rows = [(i % 40, i % 2, None if i % 3 else "a", "b" if i % 5 else None, i) for i in range(900)]
    df = spark.createDataFrame(rows, "k int, o int, x string, y string, z int")
    a = sorted(map(tuple, dedup_keep_first(df, ["k"], ["o"]).collect()))
    b = sorted(map(tuple, dedup_keep_first(df.repartition(7, "z").orderBy(F.desc("z")), ["k"], ["o"]).collect()))
    assert a == b and len(a) == 40 and all(r[1] == r[0] % 2 for r in a)


def test_dedup_many_repeated_keys(spark):
    """Heavy and light repeated keys together, composite and NULL keys."""
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 7000).alias("k"), (F.col("id") % 2).alias("j"),
                                   (-F.col("id")).alias("o"), F.col("id").alias("v"))
    want = {}
    for r in df.collect():
        if (r.k, r.j) not in want or r.o < want[r.k, r.j]:
            want[r.k, r.j] = r.o
    got = {(r.k, r.j): r.o for r in dedup_keep_first(df, ["k", "j"], ["o"]).collect()}
    assert got == want
    unique = spark.range(50).select("id", (F.col("id") * 2).alias("o"))
    assert dedup_keep_first(unique, ["id"], ["o"]).count() == 50 and dedup_keep_first(unique.limit(0), ["id"], ["o"]).count() == 0


def test_dedup_with_many_later_copies_shuffles_no_wide_rows(spark):
    """More later copies than Spark would broadcast as numbers: the written table is still not shuffled."""
    df = spark.range(2_500_000).select((F.col("id") % 1_200_000).alias("k"), (-F.col("id")).alias("o"), F.lit("wide").alias("w"), F.col("id").alias("v"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        out = dedup_keep_first(df, ["k"], ["o"])
        p = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in p and "Sort" not in p and "BroadcastHashJoin" in p
        got = out.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("k").alias("k"), F.sum("v").alias("v")).first()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert (got.n, got.k, got.v) == (1_200_000, 1_200_000, sum(range(1_300_000, 2_500_000)))


def test_dedup_ways_of_leaving_rows_out_agree(spark):
    from towerlens.operators.dedup import without_rows
    from towerlens.session import materialize
    base = materialize(spark.range(0, 200_000, 1, 5).select("id", F.monotonically_increasing_id().alias("_row")), "ways")
    later = materialize(base.where("id % 3 = 1 OR id % 64 = 63 OR id % 32768 = 0").select("_row"), "ways")
    want = {i for i in range(200_000) if not (i % 3 == 1 or i % 64 == 63 or i % 32768 == 0)}
    for kw in ({}, {"few": 0}, {"few": 0, "bitmap_bytes": 0}):
        assert sorted(r.id for r in without_rows(base, later, **kw).collect()) == sorted(want), kw


def test_dedup_shuffles_the_first_order_column_and_settles_ties_apart(spark, monkeypatch):
    """One exchange of (key, first order column, row number); the other order columns and the payload only for rows that tie."""
    from towerlens.operators import dedup
    plans, keep = {}, dedup.session.materialize

    def spy(df, name, **options):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return keep(df, name, **options)
    monkeypatch.setattr(dedup.session, "materialize", spy)
    rows = [(i % 5000, None if i % 7 == 0 else i % 3, (i * 37) % 1009, f"w{i}") for i in range(20000)]
    df = spark.createDataFrame(rows, "k int, o int, p int, w string")
    want = {}
    for k, o, p, w in rows:
        at = (o is not None, o or 0, p)
        if k not in want or at < want[k][0]:
            want[k] = (at, w)
    got = {r.k: r.w for r in dedup_keep_first(df, ["k"], ["o", "p"]).collect()}
    assert got == {k: w for k, (_, w) in want.items()} and "BroadcastHashJoin" in plans["later_ties"]
    assert "ReadSchema: struct<k:int,o:int,_row:bigint>" in plans["later_copies"]
    plans.clear()
    distinct = df.select("k", F.expr("row_number() over (order by w)").alias("o"), "p", "w")  # no ties: no second exchange
    assert dedup_keep_first(distinct, ["k"], ["o", "p"]).count() == 5000 and "later_ties" not in plans


def test_rows_named_by_numbers(spark):
    from towerlens.operators.dedup import with_rows
    from towerlens.session import materialize
    base = materialize(spark.range(0, 100_000, 1, 5).select("id", F.monotonically_increasing_id().alias("_row")), "named")
    some = materialize(base.where("id % 3 = 1 OR id % 64 = 63").select("_row"), "named")
    want = [i for i in range(100_000) if i % 3 == 1 or i % 64 == 63]
    for kw in ({}, {"few": 0}, {"few": 0, "bitmap_bytes": 0}):
        assert sorted(r.id for r in with_rows(base, some, **kw).collect()) == want, kw


def test_presence_deals_rows_before_it_makes_bitmaps(spark):
    from towerlens.operators import bitmaps
    df = spark.range(300_000).select((F.col("id") % 7).alias("day"), "id")
    bits = bitmaps.presence(df, ["day"], "id")
    plan = bits._jdf.queryExecution().executedPlan().toString()
    assert plan.index("bitmap_construct_agg") < plan.index("Exchange") and "bitmap_construct_agg" not in plan[plan.index("Exchange"):]
    got = {r.day: r.n for r in bitmaps.counted(bits, ["day"], "n").collect()}
    assert got == {d: len(range(d, 300_000, 7)) for d in range(7)}


def test_dedup_order_is_required(spark):
    with pytest.raises(ValueError):
        dedup_keep_first(spark.createDataFrame([(1, 2)], "k int, v int"), ["k"], [])


def test_dedup_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    r = dedup_counts(df, "k").first()
    assert (r.rows_in, r.rows_out) == (5, 3)


def test_outlier_filter_removes_nulls_and_counts(spark):
    df = spark.createDataFrame([(1,), (86400,), (86401,), (None,)], "d int")
    obs = Observation("o")
    kept = outlier_filter(df, "d", 86400, obs)
    assert sorted(r.d for r in kept.collect()) == [1, 86400]
    assert obs.get == {"rows_in": 4, "rows_kept": 2}


def window_pct_rank(df, col, out_col):
    """Reference form: one global window (a single task holds every row)."""
    from pyspark.sql import Window
    v = F.col(col)
    r = ((F.rank().over(Window.orderBy(v.asc_nulls_last()))
          + (F.count(F.lit(1)).over(Window.partitionBy(v)) - 1) / F.lit(2.0))
         / F.count(v).over(Window.partitionBy()))
    return df.withColumn(out_col, F.when(v.isNotNull(), r))


def test_pct_rank_average_ties(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (5.0,), (None,)], "x double")
    for fn in (pct_rank_average, window_pct_rank):
        got = sorted((r.x, r.p) for r in fn(df, "x", "p").collect() if r.x is not None)
        assert got == [(1.0, 0.25), (2.0, 0.625), (2.0, 0.625), (5.0, 1.0)]
        assert fn(df, "x", "p").where("x is null").first().p is None


def test_pct_rank_distributed_equals_window_many_buckets(spark):
    rnd = random.Random(7)
    vals = [(float(rnd.choice([0, 0, 0, rnd.randint(0, 500)])),) for _ in range(4000)]
    df = spark.createDataFrame(vals, "x double")
    dist = pct_rank_average(df, "x", "p", parts=1500)
    win = window_pct_rank(df, "x", "p")
    assert dist.exceptAll(win).count() == 0
    assert win.exceptAll(dist).count() == 0
    # mean of average ranks is (N+1)/2N
    n = df.count()
    assert abs(dist.agg(F.avg("p")).first()[0] - (n + 1) / (2 * n)) < 1e-12


def test_pct_rank_unchanged_by_repartition(spark):
    df = spark.range(3000).select((F.col("id") * 7 % 113).alias("x"))
    a = pct_rank_average(df, "x", "p", parts=7)
    b = pct_rank_average(df.repartition(5), "x", "p", parts=7)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_join_dim(spark):
    fact = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, v string")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "k int, name string")
    assert sorted((r.k, r.name) for r in join_dim(fact, dim, "k").collect()) == [(1, "one"), (2, "two"), (3, None)]


def test_match_rates_and_orphans(spark):
    fact = spark.createDataFrame([("a",), ("a",), ("b",), ("zz",), (None,)], "k string")
    dim = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    r = match_rates(fact, "k", dim, "k", "pct").first()
    assert (r.matched_rows, r.total_rows, r.pct) == (3, 5, 60.0)
    assert sorted((x.k or "") for x in orphans(fact, "k", dim, "k").collect()) == ["", "zz"]


def test_null_counts_and_value_counts(spark):
    df = spark.createDataFrame([("4G", None), ("5G", 1), ("4G", 2), (None, 3)], "t string, n int")
    assert {r.column_name: r.null_count for r in null_counts(df).collect()} == {"t": 1, "n": 1}
    assert [(r.t, r.n) for r in value_counts(df, "t").collect()] == [("4G", 2), ("5G", 1)]


def test_table_fingerprint_order_free(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).cast("string").alias("s"))
    a = table_fingerprint(df).first()
    b = table_fingerprint(df.repartition(9).orderBy(F.rand(1))).first()
    c = table_fingerprint(df.where("id > 0")).first()
    assert a == b and a != c


def test_constraints_and_gate(spark):
    df = spark.createDataFrame(
        [("1", "North", "4G", 5.0), ("1", "North", "5G", 1.0), (None, None, None, -1.0), ("3", "South", "2G", 0.0)],
        "id string, region string, technology string, m double")
    spec = TableConstraints("t", primary_key=("id",), not_null=("region",),
                            allowed_values={"technology": ("4G", "5G", "3G")}, min_values={"m": 0})
    got = {r.constraint_name: r.violations for r in constraint_violations(df, spec).collect()}
    assert got == {"primary_key(id)": 2, "not_null(region)": 1, "check(technology in (4G,5G,3G))": 1,
                   "min(m)>=0": 1}
    with pytest.raises(DataQualityError):
        enforce(constraint_violations(df, spec))
    clean = df.where("id = '3'").withColumn("technology", F.lit("3G"))
    enforce(constraint_violations(clean, spec))


def test_composite_primary_key(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "x"), ("b", None)], "k1 string, k2 string")
    spec = TableConstraints("t", primary_key=("k1", "k2"))
    assert constraint_violations(df, spec).first().violations == 2


def test_file_fingerprints_are_the_sha256_of_small_files(spark, scratch):
    import hashlib

    from towerlens.sources import file_fingerprints
    data = {"a": b"a,b\n1,2\n3,4\n", "b": b"a,b\n3,4\n1,2\n", "c": b"a,b\n1,2\r\n3,4", "d": b"", "e": b"x" * 1_000_000}
    for name, text in data.items():
        with open(f"{scratch}/{name}.csv", "wb") as fh:
            fh.write(text)
    got = {r.path[-5]: (r.size_bytes, r.checksum_sha256_16) for r in file_fingerprints(spark, f"{scratch}/*.csv").collect()}
    assert got == {k: (len(v), hashlib.sha256(v).hexdigest()[:16]) for k, v in data.items()}


def test_require_sources(spark, scratch):
    from towerlens.sources import require_sources
    from towerlens.sources.files import SourceMissingError
    require_sources(spark, {"here": scratch})
    with pytest.raises(SourceMissingError):
        require_sources(spark, {"gone": f"{scratch}/missing.csv"})


def test_orphans_of_null_and_unknown_keys(spark):
    fact = spark.createDataFrame([(i % 13 if i % 5 else None, i) for i in range(400)], "k int, v int")
    dim = spark.createDataFrame([(i,) for i in range(0, 13, 2)], "k int")
    got = orphans(fact, "k", dim, "k")
    assert got.count() == sum(1 for i in range(400) if i % 5 == 0 or (i % 13) % 2 == 1)


def test_source_file_stats_multi_file(spark, scratch):
    from towerlens.sources import source_file_stats
    folder = f"{scratch}/src"
    import os
    os.makedirs(folder)
    for i, data in enumerate([b"a\n1\n", b"a\n2\n", b"a\n3\n"]):
        with open(f"{folder}/part-{i}.csv", "wb") as fh:
            fh.write(data)
    first = source_file_stats(spark, folder).first()
    assert (first.file_count, first.size_bytes) == (3, 12)
    assert source_file_stats(spark, folder).first() == first
    with open(f"{folder}/part-1.csv", "wb") as fh:
        fh.write(b"a\n9\n")
    changed = source_file_stats(spark, folder).first()
    assert changed.size_bytes == 12 and changed.checksum_sha256_16 != first.checksum_sha256_16


def test_csv_columns_by_name_and_malformed_fields(spark, scratch):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    from towerlens.sources import malformed_fields, read_csv
    with open(f"{scratch}/t.csv", "w") as fh:
        fh.write("region,cell_tower_id,n\nNorth,TWR-1,7\nSouth,TWR-2,x\n")
    schema = StructType([StructField("cell_tower_id", StringType()), StructField("n", IntegerType()), StructField("region", StringType())])
    assert [tuple(r) for r in read_csv(spark, scratch, schema).collect()] == [("TWR-1", 7, "North"), ("TWR-2", None, "South")]
    assert [tuple(r) for r in malformed_fields(spark, scratch, schema).collect()] == [("n", 1)]


def test_rank_of_many_partitions(spark):
    df = spark.range(5000).select((F.col("id") * 13 % 4999).cast("double").alias("x"))
    dist, win = pct_rank_average(df, "x", "p", parts=1500), window_pct_rank(df, "x", "p")
    assert dist.exceptAll(win).count() == 0 and win.exceptAll(dist).count() == 0


def test_rank_with_a_third_on_one_value(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise(F.col("id").cast("double")).alias("x"))
    dist, win = pct_rank_average(df, "x", "p"), window_pct_rank(df, "x", "p")
    assert dist.exceptAll(win).count() == 0


@pytest.mark.parametrize("nulls", [False, True])
def test_rank_join_meets_no_hot_value_without_adaptive_execution(spark, nulls):
    """A third of all rows on one value, or without one: the rows are spread over the tasks of the join."""
    hot = F.lit(None).cast("double") if nulls else F.lit(0.0)
    df = spark.range(60000).select("id", F.when(F.col("id") % 3 == 0, hot).otherwise(F.col("id").cast("double")).alias("x"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        ranked = pct_rank_average(df, "x", "p", parts=8)
        sizes = sorted(r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and sizes[-1] <= 2 * sizes[len(sizes) // 2]
        win = window_pct_rank(df, "x", "p")
        assert ranked.exceptAll(win).count() == 0 and win.exceptAll(ranked).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_dq_report_keeps_every_technology_and_field(spark):
    from towerlens.plans import dq
    customers = spark.createDataFrame([("c1", 10.0, 1), ("c2", None, 0)], "customer_id string, totalcharges double, churn_flag int")
    cdrs = spark.createDataFrame([(1, "c1", "t1", 1, 0, "2026-01-01"), (2, "c2", "t9", 0, 1, "2026-01-03")],
                                 "call_id int, customer_id string, cell_tower_id string, is_completed int, is_dropped int, timestamp string")
    towers = spark.createDataFrame([("t1", "N", "3G"), ("t2", "N", "6G"), ("t3", "S", "LTE-M"), ("t4", "S", "LTE-M"), ("t5", "S", None)],
                                   "cell_tower_id string, region string, technology string")
    report = dq.dq_report(spark, customers, cdrs, towers, "now")
    assert report.first().cell_towers.technology_distribution == {"3G": 1, "6G": 1, "LTE-M": 2}
    rows = dq.dq_report_fields(report, dq.dq_technology_distribution(towers)).collect()
    assert {r.technology: r.tower_count for r in rows} == {"3G": 1, "6G": 1, "LTE-M": 2}
    r = rows[0]
    assert (r.customers_null_total_charges, r.cdrs_completed_calls_pct, r.cdrs_dropped_calls_pct, r.cdrs_date_range_max, r.cell_towers_unique_regions) == (1, 50.0, 50.0, "2026-01-03", 2)
    assert (r.referential_integrity_cdr_customer_match_rate_pct, r.referential_integrity_cdr_tower_match_rate_pct) == (100.0, 50.0)
    none = towers.where("technology = 'x'")
    empty = dq.dq_report_fields(dq.dq_report(spark, customers, cdrs, none, "now"), dq.dq_technology_distribution(none)).collect()
    assert [(r.technology, r.tower_count, r.customers_row_count) for r in empty] == [(None, None, 2)]


def test_dq_report_with_observed_measures_scans_the_cdrs_once(spark, scratch):
    from pyspark.sql import Observation

    from towerlens.plans import dq
    rows = [(i, f"c{i % 5}", f"t{i % 3}", i % 2, int(i % 7 == 0), f"2026-01-{1 + i % 28:02d} 00:00:00") for i in range(200)]
    rows += [(None, None, "t0", 0, 0, "2026-02-01 00:00:00"), (7, "nobody", None, 1, 1, None)]
    cdrs = spark.createDataFrame(rows, "call_id int, customer_id string, cell_tower_id string, is_completed int, is_dropped int, timestamp string") \
        .withColumn("timestamp", F.to_timestamp("timestamp"))
    customers = spark.createDataFrame([("c0", 1.0, 1), ("c1", 2.0, 0), ("c1", 2.0, 0), (None, 2.0, 0)], "customer_id string, totalcharges double, churn_flag int")
    towers = spark.createDataFrame([("t0", "N", "5G"), ("t1", "N", "5G")], "cell_tower_id string, region string, technology string")
    seen = Observation()
    cdrs.observe(seen, *[c.alias(k) for k, (_, c) in dq.cdr_metrics().items()]).write.parquet(f"{scratch}/cdrs")
    stored = spark.read.parquet(f"{scratch}/cdrs")
    observed = dq.dq_report(spark, customers, stored, towers, "now", observed=seen.get)
    assert observed.collect() == dq.dq_report(spark, customers, stored, towers, "now").collect()
    r = observed.first()
    assert r.cdrs == dq.dq_cdrs(stored).first() and r.cdrs.unique_call_ids == 200 and r.cdrs.row_count == 202
    assert r.referential_integrity == dq.dq_referential_integrity(stored, customers, towers).first()
    formatted = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = observed._jdf.queryExecution().explainString(formatted)
    read = {line.split(":", 1)[1].strip() for line in plan.splitlines() if line.startswith("ReadSchema")}
    assert read == {"struct<call_id:int,customer_id:string,cell_tower_id:string>"}
    assert plan.count("ReadSchema") == 1
    empty = stored.where("call_id < 0")
    assert dq.dq_report(spark, customers, empty, towers, "now").first().referential_integrity.cdr_customer_match_rate_pct is None


def test_key_census_against_counts(spark):
    from towerlens.operators import key_census
    fact = spark.createDataFrame([(1, "a"), (1, None), (2, "a"), (None, "z")], "k int, `d k` string")
    r = key_census(fact, {"k": spark.createDataFrame([(1, 9)], "k int, x int"), "d k": None}).first().asDict()
    assert r == {"k_distinct": 2, "k_rows": 4, "k_matched": 2, "k_match_pct": 50.0, "d k_distinct": 2, "d k_rows": 4, "d k_matched": 0, "d k_match_pct": 0.0}


def tree(leaves, fan):
    import hashlib
    while len(leaves) > 1:
        groups = [leaves[i:i + fan] for i in range(0, len(leaves), fan)]
        leaves = [g[0] if len(g) == 1 else hashlib.sha256("".join(g).encode()).hexdigest() for g in groups]
    return leaves[0]


def test_hash_tree_at_any_task_layout(spark, scratch, monkeypatch):
    """Files of many blocks and a source of many files equal the tree built in one place; order, line ends and empty files count."""
    import hashlib
    import os

    from towerlens.sources import file_fingerprints, files, source_file_stats
    monkeypatch.setattr(files, "FAN", 3)
    data = {f"{i:02d}": b"".join(b"%d,%d\n" % (j, j * i) for j in range(40 * i)) for i in range(11)}
    folder = f"{scratch}/s"
    os.makedirs(folder)

    def put(name, text):
        with open(f"{folder}/{name}.csv", "wb") as fh:
            fh.write(text)

    def want(text):
        return tree([hashlib.sha256(text[i:i + 100]).hexdigest() for i in range(0, max(1, len(text)), 100)], 3)
    for name, text in data.items():
        put(name, text)
    put("_SUCCESS", b"")
    got = {r.path[-6:-4]: r.checksum_sha256_16 for r in file_fingerprints(spark, folder, block=100).collect()}
    assert got == {k: want(v)[:16] for k, v in data.items()}
    first = source_file_stats(spark, folder, block=100).first()
    assert first.checksum_sha256_16 == tree([want(data[k]) for k in sorted(data)], 3)[:16]
    assert (first.file_count, first.size_bytes) == (11, sum(map(len, data.values())))
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert source_file_stats(spark, folder, block=100).first() == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    seen = {first.checksum_sha256_16}
    for text in (b"".join(reversed(data["10"].splitlines(True))), data["10"].replace(b"\n", b"\r\n"), b""):
        put("10", text)
        seen.add(source_file_stats(spark, folder, block=100).first().checksum_sha256_16)
    assert len(seen) == 4
    empty = source_file_stats(spark, folder, "*.parquet").first()
    assert (empty.file_count, empty.size_bytes, empty.checksum_sha256_16) == (0, 0, hashlib.sha256(b"").hexdigest()[:16])


def test_audit_of_landed_files_scans_each_source_once(spark, scratch):
    """Rows, NULLs and malformed fields come from one CSV scan a source, and what did not parse can be read back."""
    from towerlens.plans import bronze
    from towerlens.schemas import TOWERS_RAW_ORDERED
    from towerlens.sources import read_csv
    with open(f"{scratch}/towers.csv", "w") as fh:
        fh.write("file_row,cell_tower_id,region,city,latitude,longitude,technology,installation_date,capacity_users\n"
                 "1,t1,N,C,1.5,2.5,5G,2020-01-01,500\n2,t2,,C,x,y,4G,someday,1000\n3,t3,S,C,,2.0,4G,2020-02-30,7 users\n")
    audit = bronze.audit_landed(spark, {"cell_towers.csv": scratch})
    assert audit._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    row = audit.first()
    assert (row.row_count, row.malformed_fields, row.column_count) == (3, 5, 8)
    assert row.null_counts["latitude"] == 2 and row.null_counts["region"] == 1 and row.null_counts["installation_date"] == 2
    bad = {r.cell_tower_id: r.why for r in read_csv(spark, scratch, TOWERS_RAW_ORDERED, rescued="why").where("why is not null").collect()}
    assert bad == {"t2": {"latitude": "x", "longitude": "y", "installation_date": "someday"}, "t3": {"installation_date": "2020-02-30", "capacity_users": "7 users"}}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skewed_join_equals_the_plain_join(spark, how):
    from towerlens.operators import join_skewed
    fact = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None))
                                    .otherwise((F.col("id") % 2500).cast("string")).alias("k"), (F.col("id") % 11).alias("_salt"), F.lit(1).alias("_hot"))
    fact = fact.unionAll(fact.where("k = 'hot'"))  # repeated rows
    dim = spark.createDataFrame([("hot", "a"), ("hot", "b"), (None, "n")] + [(str(i), f"v{i}") for i in range(0, 2500, 2)], "k string, name string")
    got, want = join_skewed(fact, dim, "k", how), fact.join(dim, "k", how)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    empty = join_skewed(fact.limit(0), dim, "k", how)
    assert empty.columns == want.columns and empty.count() == 0


@pytest.mark.parametrize("nulls", [False, True])
def test_skewed_join_meets_no_hot_key_without_adaptive_execution(spark, nulls):
    """A third of all rows on one tower (or on none): every task of the join stays below twice the median."""
    from towerlens.operators import join_skewed
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        hot = F.lit(None).cast("long") if nulls else F.lit(7).cast("long")
        fact = spark.range(0, 90_000, 1, 6).select(F.when(F.col("id") % 3 == 0, hot).otherwise(F.col("id") % 20_000 + 10).alias("k"), F.lit("same").alias("v"))
        fact = fact.withColumn("n", F.col("k") * 0)  # copies: rows of a key differ in nothing
        fact = fact.withColumn("id", F.monotonically_increasing_id())
        dim = spark.range(0, 20_010).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
        joined = join_skewed(fact, dim, "k", "left")
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        plain = sorted(r["count"] for r in fact.join(dim, "k", "left").groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    middle = sizes[len(sizes) // 2]
    assert sum(sizes) == 90_000 and max(sizes) <= 2 * middle
    assert max(plain) > 2 * plain[len(plain) // 2]


def test_orphans_shuffle_no_rows_where_few_keys_are_unknown(spark):
    """The dimension is too large to be broadcast, the unknown keys are not: the rows are not shuffled for them."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        fact = spark.range(60_000).select(F.when(F.col("id") % 6 == 0, F.lit(None)).otherwise(F.col("id") % 30_000 + 5).alias("k"), F.lit("wide").alias("w"), "id")
        got = orphans(fact, "k", spark.range(30_000).select(F.col("id").alias("k")), "k")
        assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
        want = [i for i in range(60_000) if i % 6 == 0 or i % 30_000 + 5 >= 30_000]
        assert sorted(r.id for r in got.collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_merged_bitmaps_equal_exact_distinct_counts(spark):
    from towerlens.operators import bitmaps
    rows = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, F.lit("c0")).when(F.col("id") % 50 == 1, F.lit(None))
                                       .otherwise(F.concat(F.lit("c"), F.col("id") * 7919 % 70_001)).alias("customer"),
                                       (F.col("id") % 40).alias("day"), F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("place"))
    ids = bitmaps.dense_ids(rows, "customer", parts=5)
    n = rows.select("customer").where("customer IS NOT NULL").distinct().count()
    assert ids.agg(F.min("dense_id"), F.max("dense_id"), F.count_distinct("dense_id"), F.count_distinct("customer")).first()[:] == (0, n - 1, n, n)
    assert n > 2 * 32_768  # several buckets
    days = bitmaps.presence(rows.join(ids, "customer", "left"), ["day", "place"])
    exact = F.count_distinct("customer").alias("u")
    for by, want in ((["day"], rows.groupBy("day").agg(exact)), (["place"], rows.groupBy("place").agg(exact)), ([], rows.agg(exact)),
                     ([(F.col("day") % 3).alias("d3")], rows.groupBy((F.col("day") % 3).alias("d3")).agg(exact))):
        names = [c for c in want.columns if c != "u"]
        got = bitmaps.counted(bitmaps.merged(days, by), names, "u")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    none = bitmaps.presence(rows.join(ids, "customer", "left").limit(0), ["day"])
    assert bitmaps.counted(bitmaps.merged(none, []), [], "u").first().u == 0
