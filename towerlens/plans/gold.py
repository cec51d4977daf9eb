"""Gold layer: star-schema marts (M4-M7).

Scale notes:
* every mart pre-aggregates the CDRs with a map-side partial aggregate before
  any shuffle, so a customer, day or tower holding a third of all CDRs costs
  one row per map task in the exchange;
* dimensions are joined without hints: Spark broadcasts what is small in bytes; raw CDRs of hot towers are salted;
* the engagement percentile ranks never pass through one partition
  (``operators.ranking``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from towerlens.constants import ENGAGEMENT_WEIGHTS
from towerlens.functions import avg_exact, final_sum, merged_sums, partial_sums, pct, round_half_even, safe_ratio, sum_exact
from towerlens import session
from towerlens.operators import bitmaps, drop_null_keys, join_dim, join_skewed, pct_rank_average
from towerlens.schemas import CUSTOMER_SUMMARY_DEFAULTS


def _activity_measures() -> list[Column]:
    voice = F.when(F.col("call_type") == "VOICE", F.col("duration_seconds"))
    return [
        F.count("call_id").alias("total_calls"),
        round_half_even(F.coalesce(F.sum(voice), F.lit(0)) / F.lit(60.0), 2).alias("total_voice_minutes"),
        F.coalesce(sum_exact("data_mb"), F.lit(0.0)).alias("total_data_mb"),
        F.count_if(F.col("call_type") == "SMS").alias("total_sms"),
        F.coalesce(F.sum("is_dropped"), F.lit(0)).cast("bigint").alias("dropped_calls"),
        F.avg("duration_seconds").alias("avg_call_duration_sec"),
        F.max("timestamp").alias("last_activity_date"),
    ]


def customer_activity(cdrs: DataFrame) -> DataFrame:
    """Per-customer CDR aggregate (NULL customer ids form no group)."""
    return drop_null_keys(cdrs, ["customer_id"]).groupBy("customer_id").agg(*_activity_measures())


def cdrs_by_customer(cdrs: DataFrame) -> DataFrame:
    """One row for each customer id of the CDRs, NULL included: its CDRs (cdr_rows) and the measures of
    ``customer_activity``. Silver keeps it bucketed, so the match rate and the summary join it without an exchange."""
    return cdrs.groupBy("customer_id").agg(F.count(F.lit(1)).alias("cdr_rows"), *_activity_measures())


def customer_match(by_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """(customer_id_match_pct) of the CDRs counted in ``cdrs_by_customer``: those whose customer is known, in percent."""
    known = customers.select("customer_id").where(F.col("customer_id").isNotNull()).distinct().withColumn("_hit", F.lit(True))
    hits = F.coalesce(F.sum(F.when(F.col("_hit"), F.col("cdr_rows"))), F.lit(0)).cast("double")
    return by_customer.select("customer_id", "cdr_rows").join(known, "customer_id", "left").agg(
        (F.try_divide(hits, F.sum("cdr_rows")) * 100).alias("customer_id_match_pct"))


def join_activity(customers: DataFrame, activity: DataFrame) -> DataFrame:
    """customers LEFT JOIN activity, activity columns zero-filled (the last
    activity stays NULL for customers without CDRs)."""
    return customers.join(activity.drop("cdr_rows"), "customer_id", "left").fillna(CUSTOMER_SUMMARY_DEFAULTS)


def customer_summary_base(customers: DataFrame, cdrs: DataFrame) -> DataFrame:
    """Customers with their activity, aggregated from the CDRs."""
    return join_activity(customers, customer_activity(cdrs))


def engagement_score(base: DataFrame, rank_parts: int | None = None) -> DataFrame:
    """Weighted sum of three average-rank percentiles, 2 decimals, plus CLV.

    Hot values (no data, no calls) are told by broadcast, so no join meets them (``operators.ranking``).
    """
    out = base
    score = None
    for col, weight in ENGAGEMENT_WEIGHTS:
        rcol = f"_pct_{col}"
        out = pct_rank_average(out, col, rcol, rank_parts, among=base)
        term = F.col(rcol) * F.lit(weight)
        score = term if score is None else score + term
    out = out.withColumn("engagement_score", round_half_even(score, 2))
    out = out.withColumn("estimated_clv_usd",
                         round_half_even(F.col("monthlycharges") * F.col("tenure"), 2))
    return out.select(*base.columns, "engagement_score", "estimated_clv_usd")


def fact_customer_summary(customers: DataFrame, cdrs: DataFrame, rank_parts: int | None = None,
                          by_customer: DataFrame | None = None) -> DataFrame:
    """M4: one row per customer with activity, engagement score and CLV.

    ``by_customer`` (``cdrs_by_customer`` of these CDRs, as silver keeps it) saves the scan of the CDRs; bucketed
    like the customers it joins them without an exchange.

    The joined base feeds three rank computations and the final join; it is
    written once as a Parquet table in the session's shared checkpoint folder,
    which also cuts the lineage back to the CDR scan, so a lost executor does
    not replay the CDR aggregation.
    """
    joined = customer_summary_base(customers, cdrs) if by_customer is None else join_activity(customers, by_customer)
    base = session.materialize(joined, "customer_summary_base")
    return engagement_score(base, rank_parts)


def _distinct(col: str, exact: bool):
    """Exact distinct count (Spark expands distinct aggregates into a
    two-level aggregate) or, opt-in, HyperLogLog++ (one pass, no expansion,
    about 2 % relative error)."""
    return F.count_distinct(col) if exact else F.approx_count_distinct(col, 0.02)


def fact_daily_network_metrics(cdrs: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """M5: one row per call_date."""
    daily = drop_null_keys(cdrs, ["call_date"]).groupBy("call_date").agg(
        F.count("call_id").alias("total_calls"),
        F.sum("is_completed").cast("bigint").alias("completed_calls"),
        F.sum("is_dropped").cast("bigint").alias("dropped_calls"),
        _distinct("customer_id", exact_distinct).alias("unique_customers_active"),
        F.coalesce(sum_exact("data_mb"), F.lit(0.0)).alias("total_data_mb"),
        F.avg("duration_seconds").alias("avg_duration_sec"),
        F.coalesce(sum_exact("cost_usd"), F.lit(0.0)).alias("total_revenue_usd"),
    )
    return daily.withColumns({
        "drop_rate_pct": round_half_even(pct("dropped_calls", "total_calls"), 3),
        "call_success_rate_pct": round_half_even(pct("completed_calls", "total_calls"), 3),
    })


def cdr_tower_enrich(cdrs: DataFrame, towers: DataFrame) -> DataFrame:
    """CDRs LEFT JOIN towers(cell_tower_id, region, city, technology); a hot tower's CDRs are dealt over many tasks."""
    dim = towers.select("cell_tower_id", "region", "city", "technology")
    return join_skewed(cdrs, dim, "cell_tower_id", "left")


def activity_bitmaps(cdrs: DataFrame, towers: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """(call_date, region, bucket, bits): which customers were active on a day in a region (NULL: unknown tower).

    Written once; every coarser count comes from it without a look at the CDRs. CDRs are first reduced to distinct
    (day, tower, customer), so a hot customer or tower joins with one row for each of them. ``customers`` numbers the
    customers (``bitmaps.dense_ids``; default: numbered from the CDRs).
    """
    seen = cdrs.select("call_date", "cell_tower_id", "customer_id").where(F.col("customer_id").isNotNull()).distinct()
    ids = customers if customers is not None else bitmaps.dense_ids(cdrs, "customer_id")
    placed = join_dim(seen, towers.select("cell_tower_id", "region"), "cell_tower_id", "left")
    numbered = join_dim(placed, ids, "customer_id", "inner")
    return session.materialize(bitmaps.presence(numbered, ["call_date", "region"]), "activity_bitmaps")


def active_customers(activity: DataFrame) -> DataFrame:
    """(level, period, unique_customers): exact active customers by day, month, region and over all, from the bitmaps alone."""
    day = bitmaps.merged(activity.where(F.col("call_date").isNotNull()), ["call_date"])
    month = bitmaps.merged(day, [F.date_format("call_date", "yyyy-MM").alias("month")])
    region = bitmaps.merged(activity.where(F.col("region").isNotNull()), ["region"])
    levels = [("day", bitmaps.counted(day, ["call_date"], "unique_customers").withColumnRenamed("call_date", "period")),
              ("month", bitmaps.counted(month, ["month"], "unique_customers").withColumnRenamed("month", "period")),
              ("region", bitmaps.counted(region, ["region"], "unique_customers").withColumnRenamed("region", "period")),
              ("all", bitmaps.counted(bitmaps.merged(activity, []), [], "unique_customers").withColumn("period", F.lit("all")))]
    rows = [df.select(F.lit(level).alias("level"), F.col("period").cast("string").alias("period"), "unique_customers") for level, df in levels]
    return reduce(DataFrame.unionByName, rows)


def fact_regional_performance(cdrs: DataFrame, towers: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """M6: one row per region; CDRs of unknown towers have no region and
    drop out of the grouping.

    CDRs are first aggregated to (tower, customer), so neither a hot tower nor
    the tower columns meet the raw rows; distinct customers and towers are
    then counted from (region, customer) and (region, tower) rows, each by a
    plain two-step aggregate.
    """
    narrow = drop_null_keys(cdrs, ["cell_tower_id"]).groupBy("cell_tower_id", "customer_id").agg(
        F.count("call_id").alias("calls"), F.sum("is_completed").alias("completed"), F.sum("is_dropped").alias("dropped"),
        *partial_sums("data_mb", "mb"), *partial_sums("cost_usd", "usd"))
    known = drop_null_keys(join_dim(narrow, towers.select("cell_tower_id", "region"), "cell_tower_id", "left"), ["region"])
    per_tower = known.groupBy("region", "cell_tower_id").agg(
        *[F.sum(c).alias(c) for c in ("calls", "completed", "dropped")], *merged_sums("mb"), *merged_sums("usd"))
    totals = per_tower.groupBy("region").agg(
        F.sum("calls").alias("total_calls"), F.sum("completed").cast("bigint").alias("completed_calls"),
        F.sum("dropped").cast("bigint").alias("dropped_calls"),
        F.coalesce(final_sum("mb"), F.lit(0.0)).alias("total_data_mb"),
        F.coalesce(final_sum("usd"), F.lit(0.0)).alias("total_revenue_usd"),
        F.count(F.lit(1)).alias("active_towers"))
    if exact_distinct:
        people = known.select("region", "customer_id").distinct().groupBy("region").agg(F.count("customer_id").alias("unique_customers"))
    else:
        people = known.groupBy("region").agg(F.approx_count_distinct("customer_id", 0.02).alias("unique_customers"))
    regional = totals.join(people, "region").select(
        "region", "total_calls", "completed_calls", "dropped_calls", "unique_customers", "total_data_mb",
        "total_revenue_usd", "active_towers")
    return regional.withColumns({
        "drop_rate_pct": round_half_even(pct("dropped_calls", "total_calls"), 3),
        "revenue_per_customer_usd": round_half_even(
            safe_ratio("total_revenue_usd", "unique_customers"), 2),
    })


def fact_churn_cohort(summary: DataFrame) -> DataFrame:
    """M7: churn by (tenure cohort, contract, payment method), observed
    combinations only, highest churn rate first."""
    keys = ["tenure_cohort", "contract", "paymentmethod"]
    cohort = drop_null_keys(summary, keys).groupBy(*keys).agg(
        F.count("customer_id").alias("customer_count"),
        F.sum("churn_flag").cast("bigint").alias("churn_count"),
        avg_exact("monthlycharges").alias("avg_monthly_charges"),
        avg_exact("totalcharges").alias("avg_total_charges"),
        avg_exact("estimated_clv_usd").alias("avg_clv"),
    )
    cohort = cohort.withColumn("churn_rate_pct",
                               round_half_even(pct("churn_count", "customer_count"), 2))
    return cohort.orderBy(F.col("churn_rate_pct").desc_nulls_last(), *keys)
