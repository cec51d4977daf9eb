"""Business queries over the marts (Q1-Q10), the tuned/naive query pairs
(Ex1-Ex6) and the warehouse smoke query (V1).

SQL ``ROUND`` is ``round_half_up``; money and megabyte sums and means go
through exact decimal sums so results do not depend on row order.
Ordered top-k queries carry every key as a tie-break, so the rows kept under
a LIMIT are deterministic.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from towerlens.constants import (
    AT_RISK_MIN_MONTHLY,
    ENGAGEMENT_SQL_EDGES,
    ENGAGEMENT_SQL_LABELS,
    HIGH_RISK_MIN_CUSTOMERS,
    MONTH_TO_MONTH,
)
from towerlens.functions import avg_exact, bucketize, round_half_up, sum_exact

COHORT_KEYS = ["tenure_cohort", "contract", "paymentmethod"]


def _churn_pct():
    return round_half_up(F.avg("churn_flag") * F.lit(100), 2)


def q01_executive_kpis(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum("churn_flag").cast("bigint").alias("churned_customers"),
        _churn_pct().alias("churn_rate_pct"),
        round_half_up(sum_exact("monthlycharges"), 2).alias("monthly_revenue_usd"),
        round_half_up(avg_exact("monthlycharges"), 2).alias("arpu_usd"),
        round_half_up(sum_exact("estimated_clv_usd"), 2).alias("total_clv_usd"),
        round_half_up(F.avg("tenure"), 1).alias("avg_tenure_months"),
    )


def q02_churn_by_contract(summary: DataFrame) -> DataFrame:
    return summary.groupBy("contract").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("churn_flag").cast("bigint").alias("churned"),
        _churn_pct().alias("churn_rate_pct"),
        round_half_up(avg_exact("monthlycharges"), 2).alias("avg_monthly_charges"),
        round_half_up(F.avg("tenure"), 1).alias("avg_tenure_months"),
    ).orderBy(F.col("churn_rate_pct").desc(), "contract")


def q03_high_risk_segments(cohort: DataFrame, k: int = 10) -> DataFrame:
    return (cohort.where(F.col("customer_count") >= HIGH_RISK_MIN_CUSTOMERS)
            .select(*COHORT_KEYS, "customer_count", "churn_count", "churn_rate_pct",
                    round_half_up("avg_monthly_charges", 2).alias("avg_monthly_charges"))
            .orderBy(F.col("churn_rate_pct").desc(), *COHORT_KEYS).limit(k))


def q04_churn_by_internet(summary: DataFrame) -> DataFrame:
    return summary.groupBy("internetservice").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("churn_flag").cast("bigint").alias("churned"),
        _churn_pct().alias("churn_rate_pct"),
        round_half_up(avg_exact("monthlycharges"), 2).alias("arpu"),
    ).orderBy(F.col("churn_rate_pct").desc(), "internetservice")


def at_risk(summary: DataFrame) -> DataFrame:
    """Active month-to-month customers paying more than the threshold."""
    return summary.where((F.col("churn_flag") == 0) & (F.col("contract") == MONTH_TO_MONTH)
                         & (F.col("monthlycharges") > AT_RISK_MIN_MONTHLY))


def q05_revenue_at_risk(summary: DataFrame) -> DataFrame:
    return at_risk(summary).groupBy("tenure_cohort", "contract").agg(
        F.count(F.lit(1)).alias("at_risk_customer_count"),
        round_half_up(sum_exact("monthlycharges"), 2).alias("monthly_revenue_at_risk_usd"),
        round_half_up(sum_exact("estimated_clv_usd"), 2).alias("clv_at_risk_usd"),
    ).orderBy(F.col("monthly_revenue_at_risk_usd").desc(), "tenure_cohort")


def q06_network_by_region(regional: DataFrame) -> DataFrame:
    return regional.select(
        "region", "total_calls", "completed_calls", "dropped_calls", "drop_rate_pct",
        round_half_up(F.col("total_data_mb") / F.lit(1024), 2).alias("total_data_gb"),
        "active_towers",
        round_half_up(F.col("total_calls") * F.lit(1.0) / F.col("active_towers"), 1).alias("calls_per_tower"),
        "revenue_per_customer_usd",
    ).orderBy(F.col("total_calls").desc(), "region")


def q07_daily_health_30(daily: DataFrame, k: int = 30) -> DataFrame:
    return daily.select(
        "call_date", "total_calls", "drop_rate_pct", "call_success_rate_pct",
        "unique_customers_active",
        round_half_up(F.col("total_data_mb") / F.lit(1024), 2).alias("data_gb"),
        round_half_up("total_revenue_usd", 2).alias("revenue_usd"),
    ).orderBy(F.col("call_date").desc()).limit(k)


def engagement_band_sql(col: str = "engagement_score"):
    """Left-closed searched CASE; NULL falls to the last band (ELSE)."""
    return bucketize(col, ENGAGEMENT_SQL_EDGES, ENGAGEMENT_SQL_LABELS, closed="left")


def q08_engagement_vs_churn(summary: DataFrame) -> DataFrame:
    return summary.withColumn("engagement_band", engagement_band_sql()).groupBy(
        "engagement_band").agg(
        F.count(F.lit(1)).alias("customers"),
        _churn_pct().alias("churn_rate_pct"),
        round_half_up(avg_exact("monthlycharges"), 2).alias("avg_arpu"),
        round_half_up(avg_exact("total_data_mb"), 2).alias("avg_data_mb"),
        round_half_up(F.avg("total_calls"), 1).alias("avg_calls"),
    ).orderBy("engagement_band")


def q09_payment_vs_churn(summary: DataFrame) -> DataFrame:
    return summary.groupBy("paymentmethod").agg(
        F.count(F.lit(1)).alias("customers"),
        _churn_pct().alias("churn_rate_pct"),
        round_half_up(avg_exact("monthlycharges"), 2).alias("avg_arpu"),
        round_half_up(F.avg("tenure"), 1).alias("avg_tenure"),
    ).orderBy(F.col("churn_rate_pct").desc(), "paymentmethod")


def q10_tenure_cohort_revenue(summary: DataFrame) -> DataFrame:
    """Text order of the cohort label (0-6mo, 1-2yr, 2-4yr, 4yr+, 6-12mo),
    as the SQL ORDER BY states; NULL cohort sorts first as in SQL engines
    that put NULLs first ascending."""
    return summary.groupBy("tenure_cohort").agg(
        F.count(F.lit(1)).alias("customers"),
        _churn_pct().alias("churn_rate_pct"),
        round_half_up(sum_exact("monthlycharges"), 2).alias("monthly_revenue_usd"),
        round_half_up(avg_exact("estimated_clv_usd"), 2).alias("avg_clv_usd"),
    ).orderBy("tenure_cohort")


def cohort_preview(cohort: DataFrame, n: int = 5) -> DataFrame:
    """First n cohorts of the churn mart in its order (highest churn first)."""
    return cohort.orderBy(F.col("churn_rate_pct").desc(), *COHORT_KEYS).limit(n)


def ex1_having_form(summary: DataFrame) -> DataFrame:
    """Filter after the aggregate (HAVING on the key); Catalyst pushes it
    below the aggregate and into the Parquet scan."""
    return (summary.groupBy("contract").agg((F.avg("churn_flag") * F.lit(100)).alias("churn_rate_pct"))
            .where(F.col("contract") == MONTH_TO_MONTH))


def ex1_where_form(summary: DataFrame) -> DataFrame:
    return (summary.where(F.col("contract") == MONTH_TO_MONTH).groupBy("contract")
            .agg((F.avg("churn_flag") * F.lit(100)).alias("churn_rate_pct")))


def ex2_preaggregated_distinct(regional: DataFrame) -> DataFrame:
    return regional.select("region", "unique_customers")


def ex3_topk_cohorts(cohort: DataFrame, k: int = 10) -> DataFrame:
    return (cohort.where(F.col("customer_count") >= HIGH_RISK_MIN_CUSTOMERS)
            .select(*COHORT_KEYS, "churn_rate_pct")
            .orderBy(F.col("churn_rate_pct").desc(), *COHORT_KEYS).limit(k))


def ex4_upper_predicate(summary: DataFrame) -> DataFrame:
    return summary.where(F.upper(F.col("contract")) == MONTH_TO_MONTH.upper())


def ex4_plain_predicate(summary: DataFrame) -> DataFrame:
    return summary.where(F.col("contract") == MONTH_TO_MONTH)


def ex5_rank_in_cohort(summary: DataFrame, k: int = 50) -> DataFrame:
    """RANK() of CLV within each tenure cohort (active customers), first k
    by (cohort, rank).

    A row ranked above k cannot be among the first k rows ordered by (cohort,
    rank), so the ``rank <= k`` filter is exact; Spark turns it into a
    per-partition group limit before the shuffle, which keeps a cohort that
    holds a third of all customers from reaching one task whole.
    """
    w = Window.partitionBy("tenure_cohort").orderBy(F.col("estimated_clv_usd").desc())
    ranked = (summary.where(F.col("churn_flag") == 0)
              .select("customer_id", "tenure_cohort", "estimated_clv_usd",
                      F.rank().over(w).alias("clv_rank_in_cohort")))
    return (ranked.where(F.col("clv_rank_in_cohort") <= k)
            .orderBy(F.col("tenure_cohort").asc_nulls_first(), "clv_rank_in_cohort", "customer_id")
            .limit(k))


def ex6_cte_at_risk(spark: SparkSession, summary: DataFrame) -> DataFrame:
    """Two chained CTEs in SQL text over a temp view; the CTEs are inlined
    and the filter reaches the scan."""
    view = f"_tl_customer_summary_{uuid.uuid4().hex}"
    summary.createOrReplaceTempView(view)
    return spark.sql(f"""
        WITH monthly AS (SELECT tenure_cohort AS cohort, CAST(monthlycharges AS DECIMAL(38,9)) AS fee FROM {view}
                         WHERE contract = '{MONTH_TO_MONTH}' AND churn_flag = 0 AND monthlycharges > {AT_RISK_MIN_MONTHLY}),
             totals AS (SELECT cohort, COUNT(*) AS n, CAST(SUM(fee) AS DOUBLE) AS fees FROM monthly GROUP BY cohort)
        SELECT cohort AS tenure_cohort, n AS at_risk_count, fees AS monthly_revenue_at_risk FROM totals
        ORDER BY fees DESC, cohort
    """)


def v1_regional_snapshot(spark: SparkSession, regional: DataFrame) -> DataFrame:
    """Warehouse smoke query: SQL text over the registered mart."""
    view = f"_tl_fact_regional_performance_{uuid.uuid4().hex}"
    regional.createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT region, total_calls, drop_rate_pct, revenue_per_customer_usd
        FROM {view}
        ORDER BY total_calls DESC, region
    """)
