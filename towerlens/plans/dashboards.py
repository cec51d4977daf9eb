"""Dashboard datasets (D0-D5): the numbers behind the KPI tiles and five
charts, each a small DataFrame computed on the cluster. Drawing is not done
here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens.constants import (
    CONTRACT_SHORT,
    ENGAGEMENT_DASH_EDGES,
    ENGAGEMENT_DASH_LABELS,
    HIGH_RISK_MIN_CUSTOMERS,
    PAYMENT_SHORT,
)
from towerlens.functions import avg_exact, bucketize, sum_exact

COHORT_KEYS = ["tenure_cohort", "contract", "paymentmethod"]


def d0_kpi_tiles(summary: DataFrame) -> DataFrame:
    """Customers, churn %, monthly recurring revenue, ARPU, churned MRR."""
    return summary.agg(
        F.count(F.lit(1)).alias("total_customers"),
        (F.avg("churn_flag") * F.lit(100)).alias("churn_rate"),
        sum_exact("monthlycharges").alias("mrr"),
        avg_exact("monthlycharges").alias("arpu"),
        F.coalesce(sum_exact(F.when(F.col("churn_flag") == 1, F.col("monthlycharges"))),
                   F.lit(0.0)).alias("lost_mrr"),
    )


def d1_contract_churn(summary: DataFrame) -> DataFrame:
    return (summary.where(F.col("contract").isNotNull()).groupBy("contract").agg(
        (F.avg("churn_flag") * F.lit(100)).alias("churn_rate"),
        F.count("customer_id").alias("customers"),
    ).orderBy(F.col("churn_rate").desc(), "contract"))


def _replace_all(c, pairs):
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def d2_top_cohorts(cohort: DataFrame, k: int = 8) -> DataFrame:
    """The k highest churn-rate cohorts with n >= 50, shown ascending, with a
    short label "cohort | contract | payment" (literal replacements; a NULL
    part is skipped)."""
    top = (cohort.where(F.col("customer_count") >= HIGH_RISK_MIN_CUSTOMERS)
           .orderBy(F.col("churn_rate_pct").desc(), *COHORT_KEYS).limit(k))
    label = F.concat_ws(" | ", F.col("tenure_cohort"),
                        _replace_all(F.col("contract"), CONTRACT_SHORT),
                        _replace_all(F.col("paymentmethod"), PAYMENT_SHORT))
    return (top.select(*COHORT_KEYS, "customer_count", "churn_rate_pct", label.alias("label"))
            .orderBy(F.col("churn_rate_pct").asc(), *[F.col(c).desc() for c in COHORT_KEYS]))


def d3_regional_sorted(regional: DataFrame) -> DataFrame:
    return regional.select("region", "total_calls", "drop_rate_pct").orderBy(
        F.col("total_calls").desc(), "region")


def d4_daily_success_trend(daily: DataFrame) -> DataFrame:
    """Daily success rate with the unweighted mean over all days as a
    reference line. The mean is a scalar subquery (no join, no window over a
    single partition)."""
    mean = daily.agg(avg_exact("call_success_rate_pct")).scalar()
    return daily.select("call_date", "call_success_rate_pct",
                        mean.alias("mean_success_rate_pct")).orderBy("call_date")


def d5_engagement_bands_right(summary: DataFrame) -> DataFrame:
    """Right-closed bands (-1,25], (25,50], (50,75], (75,101]; a score in no
    band (or NULL) is left out."""
    banded = summary.withColumn("eng_band", bucketize(
        "engagement_score", ENGAGEMENT_DASH_EDGES, ENGAGEMENT_DASH_LABELS, closed="right"))
    return (banded.where(F.col("eng_band").isNotNull()).groupBy("eng_band").agg(
        (F.avg("churn_flag") * F.lit(100)).alias("churn_rate"),
        F.count("customer_id").alias("customers"),
        avg_exact("monthlycharges").alias("avg_revenue"),
    ).orderBy("eng_band"))
