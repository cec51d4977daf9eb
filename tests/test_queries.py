"""Query layer: golden values from the reference's committed marts, the
naive == tuned pairs, top-k against brute force, and the sf0.01 fixture
values."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from towerlens.plans import analytics as A
from towerlens.plans import dashboards as D
from towerlens.plans.warehouse import Warehouse
from towerlens.schemas import FACT_DAILY_NETWORK_METRICS, FACT_REGIONAL_PERFORMANCE

from .conftest import SF_ORACLE

# Golden mart rows (fixed values copied from the reference's committed outputs).
REGIONAL_ROWS = [
    ("Central", 8293, 7625, 422, 4912, 174878.046, 14611.668, 33, 5.089, 2.97),
    ("East", 10389, 9614, 485, 5394, 220438.394, 17550.3219, 42, 4.668, 3.25),
    ("North", 8918, 8186, 477, 5047, 195685.42, 15866.4602, 36, 5.349, 3.14),
    ("South", 10187, 9366, 521, 5411, 213526.188, 17345.4802, 40, 5.114, 3.21),
    ("West", 12213, 11266, 572, 5832, 264120.24, 22422.1651, 49, 4.684, 3.84),
]
DAILY_ROWS = [
    (dt.date(2026, 5, 25), 551, 508, 23, 539, 11540.812, 307.37386569872956, 896.7354, 4.174, 92.196),
    (dt.date(2026, 5, 26), 82, 74, 5, 81, 1504.098, 289.6951219512195, 138.9368, 6.098, 90.244),
]


def test_q06_golden(spark):
    regional = spark.createDataFrame(REGIONAL_ROWS, FACT_REGIONAL_PERFORMANCE)
    got = [tuple(r) for r in A.q06_network_by_region(regional).collect()]
    assert got[0] == ("West", 12213, 11266, 572, 4.684, 257.93, 49, 249.2, 3.84)
    assert [(r[0], r[5], r[7]) for r in got] == [
        ("West", 257.93, 249.2), ("East", 215.27, 247.4), ("South", 208.52, 254.7),
        ("North", 191.1, 247.7), ("Central", 170.78, 251.3)]


def test_q07_golden_latest_days(spark):
    daily = spark.createDataFrame(DAILY_ROWS, FACT_DAILY_NETWORK_METRICS)
    got = [tuple(r) for r in A.q07_daily_health_30(daily).collect()]
    assert got == [(dt.date(2026, 5, 26), 82, 6.098, 90.244, 81, 1.47, 138.94),
                   (dt.date(2026, 5, 25), 551, 4.174, 92.196, 539, 11.27, 896.74)]


def test_v1_and_d3_order(spark):
    regional = spark.createDataFrame(REGIONAL_ROWS, FACT_REGIONAL_PERFORMANCE)
    assert [r.region for r in A.v1_regional_snapshot(spark, regional).collect()] == [
        "West", "East", "South", "North", "Central"]
    assert [r.region for r in D.d3_regional_sorted(regional).collect()][0] == "West"


def warehouse(spark):
    return Warehouse.from_sources(spark, SF_ORACLE)


def test_q02_fixture_values(spark):
    got = [tuple(r) for r in A.q02_churn_by_contract(warehouse(spark).customer_summary).collect()]
    assert got == [("Month-to-month", 610, 267, 43.77, 54.63, 36.3), ("One year", 298, 28, 9.4, 57.84, 37.1),
                   ("Two year", 592, 22, 3.72, 53.83, 38.8)]


def test_naive_equals_tuned(spark):
    s = warehouse(spark).customer_summary
    assert A.ex1_having_form(s).collect() == A.ex1_where_form(s).collect()
    up, plain = A.ex4_upper_predicate(s), A.ex4_plain_predicate(s)
    assert up.exceptAll(plain).count() == 0 and plain.exceptAll(up).count() == 0
    # the tuned form reaches the Parquet scan as a pushed equality; UPPER does not
    w = Warehouse.from_sources(spark, SF_ORACLE)
    plan = A.ex4_plain_predicate(w.customers_raw.withColumnRenamed("Contract", "contract"))._jdf \
        .queryExecution().executedPlan().toString()
    assert "Filter" in plan


def test_ex5_topk_equals_brute_force(spark):
    s = warehouse(spark).customer_summary
    fast = [tuple(r) for r in A.ex5_rank_in_cohort(s).collect()]
    w = Window.partitionBy("tenure_cohort").orderBy(F.col("estimated_clv_usd").desc())
    full = (s.where("churn_flag = 0").select("customer_id", "tenure_cohort", "estimated_clv_usd",
                                             F.rank().over(w).alias("clv_rank_in_cohort"))
            .orderBy("tenure_cohort", "clv_rank_in_cohort", "customer_id").collect())
    assert fast == [tuple(r) for r in full[:50]]


def test_cohort_rollups_consistent(spark):
    w = warehouse(spark)
    cohort = w.cohort
    totals = cohort.agg(F.sum("customer_count").alias("n"), F.sum("churn_count").alias("c")).first()
    kpi = A.q01_executive_kpis(w.customer_summary).first()
    assert (totals.n, totals.c) == (kpi.total_customers, kpi.churned_customers)
    top = D.d2_top_cohorts(cohort).collect()
    assert len(top) <= 8 and all(r.customer_count >= 50 for r in top)
    assert [r.churn_rate_pct for r in top] == sorted(r.churn_rate_pct for r in top)
    assert all(" | " in r.label and "(automatic)" not in r.label for r in top)
    mean = D.d4_daily_success_trend(w.daily).select("mean_success_rate_pct").distinct().collect()
    assert len(mean) == 1
