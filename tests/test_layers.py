"""Silver and gold layers on hand-made edge rows (FIXTURES section 4)."""

import datetime as dt

from pyspark.sql import functions as F

from towerlens.plans import gold, silver
from towerlens.schemas import CDRS_RAW, CUSTOMERS_RAW, TOWERS_RAW


def ordered(df):
    return df.withColumn("file_row", F.monotonically_increasing_id())


def customer(cid, tenure, monthly, total, churn="No", contract="Month-to-month", pay="Electronic check"):
    return (cid, "Male", 0, "No", "No", tenure, "Yes", "No", "DSL", "No", "No", "No", "No", "No", "No",
            contract, "Yes", pay, monthly, total, churn)


def test_clean_customers_imputation_and_cohorts(spark):
    rows = [customer("c1", 0, 30.0, " "), customer("c2", 0, 30.0, "50"), customer("c3", 5, 20.0, "n/a"),
            customer("c4", 12, 10.0, "120.5", churn="Yes"), customer("c4", 3, 1.0, "1", churn="No"),
            customer("c5", 101, 10.0, "1010")]
    df = silver.clean_customers(ordered(spark.createDataFrame(rows, CUSTOMERS_RAW)), ["file_row"])
    got = {r.customer_id: r for r in df.collect()}
    assert got["c1"].totalcharges == 0.0 and got["c2"].totalcharges == 0.0
    assert got["c3"].totalcharges == 20.0
    assert got["c4"].tenure == 12 and got["c4"].churn_flag == 1 and got["c4"].tenure_cohort == "6-12mo"
    assert got["c5"].tenure_cohort is None
    assert df.columns[:2] == ["customer_id", "gender"] and df.columns[-3:] == [
        "churn_flag", "is_senior_citizen", "tenure_cohort"]


def cdr(cid, cust, ts, ctype="VOICE", dur=60, nbytes=0, tower="t1", status="COMPLETED", cost=0.1):
    return (cid, cust, ts, ctype, dur, nbytes, tower, status, cost)


def test_clean_cdrs_order_of_steps(spark):
    rows = [cdr("a", "c1", "2026-01-01T10:00:00"), cdr("a", "c1", "2026-01-02T10:00:00"),
            cdr("b", "c1", "bad-ts"), cdr("c", "c2", "2026-01-03T00:00:00", dur=90000),
            cdr("d", "c2", "2026-01-04T23:59:59", dur=None), cdr("e", "c2", "2026-01-05T01:00:00", status=None,
                                                                  ctype="DATA", nbytes=1572864)]
    raw = spark.createDataFrame(rows, CDRS_RAW).withColumn("ord", F.monotonically_increasing_id())
    df = silver.clean_cdrs(raw, ["ord"])
    got = {r.call_id: r for r in df.collect()}
    assert set(got) == {"a", "e"}
    assert got["a"].call_date == dt.date(2026, 1, 1) and got["a"].day_of_week == "Thursday"
    assert got["a"].call_hour == 10 and got["a"].is_completed == 1
    assert got["e"].is_completed == 0 and got["e"].is_dropped == 0 and got["e"].data_mb == 1.5
    assert "ord" not in df.columns


def test_towers_years_in_service(spark):
    rows = [("t1", "North", "Delhi", 28.0, 75.0, "5G", dt.date(2023, 12, 15), 500),
            ("t2", "Central", "Indore", 23.9, 68.9, "4G", dt.date(2021, 6, 30), 1000)]
    df = silver.clean_cell_towers(ordered(spark.createDataFrame(rows, TOWERS_RAW)), "2026-05-26", ["file_row"])
    # values from the reference's committed tower dimension for that day
    assert {r.cell_tower_id: r.years_in_service for r in df.collect()} == {"t1": 2.44, "t2": 4.9}


def test_gold_edges(spark):
    customers = silver.clean_customers(spark.createDataFrame(
        [customer("c1", 10, 50.0, "500"), customer("c2", 20, 60.0, "1200"), customer("c3", 30, 70.0, "2100")],
        CUSTOMERS_RAW).withColumn("file_row", F.lit(1)), ["file_row"])
    raw = spark.createDataFrame([
        cdr("a", "c1", "2026-01-01T10:00:00", tower="t1", cost=0.25),
        cdr("b", "c1", "2026-01-01T11:00:00", ctype="SMS", tower="t1", status="DROPPED", cost=0.5),
        cdr("c", "c2", "2026-01-02T11:00:00", ctype="DATA", nbytes=2097152, tower="unknown", cost=1.0),
        cdr("d", None, "2026-01-02T12:00:00", tower="t1", cost=2.0)], CDRS_RAW)
    cdrs = silver.clean_cdrs(raw.withColumn("ord", F.lit(0)), ["ord"])
    towers = silver.clean_cell_towers(spark.createDataFrame(
        [("t1", "North", "Delhi", 28.0, 75.0, "5G", dt.date(2023, 12, 15), 500)], TOWERS_RAW).withColumn("file_row", F.lit(1)), "2026-05-26", ["file_row"])
    summary = {r.customer_id: r for r in gold.fact_customer_summary(customers, cdrs).collect()}
    assert summary["c3"].total_calls == 0 and summary["c3"].total_data_mb == 0.0
    assert summary["c3"].last_activity_date is None
    assert summary["c1"].total_calls == 2 and summary["c1"].total_sms == 1 and summary["c1"].dropped_calls == 1
    assert summary["c1"].total_voice_minutes == 1.0 and summary["c2"].total_data_mb == 2.0
    assert summary["c3"].estimated_clv_usd == 2100.0
    regional = gold.fact_regional_performance(cdrs, towers).collect()
    assert [(r.region, r.total_calls, r.unique_customers, r.active_towers) for r in regional] == [("North", 3, 1, 1)]
    daily = {r.call_date: r for r in gold.fact_daily_network_metrics(cdrs).collect()}
    assert daily[dt.date(2026, 1, 1)].drop_rate_pct == 50.0
    assert daily[dt.date(2026, 1, 2)].total_revenue_usd == 3.0
    # property: daily totals = regional totals + CDRs of unknown towers
    unmatched = cdrs.join(towers, "cell_tower_id", "left_anti").count()
    assert sum(r.total_calls for r in daily.values()) == sum(r.total_calls for r in regional) + unmatched


def test_approx_distinct_opt_in(spark):
    from towerlens.plans.warehouse import Warehouse
    w = Warehouse.from_sources(spark, "/root/testdata/sf0.01")
    exact = {r.call_date: r.unique_customers_active for r in gold.fact_daily_network_metrics(w.cdrs).collect()}
    approx = gold.fact_daily_network_metrics(w.cdrs, exact_distinct=False)
    assert "Expand" not in approx._jdf.queryExecution().executedPlan().toString()
    for r in approx.collect():
        assert abs(r.unique_customers_active - exact[r.call_date]) <= max(2, 0.06 * exact[r.call_date])
