"""End-to-end pipeline on sf0.001: outputs, reports, gates, sinks."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from towerlens.operators import DataQualityError
from towerlens.plans import pipeline
from towerlens.plans.warehouse import Warehouse
from towerlens.schemas import FACT_CUSTOMER_SUMMARY, MART_SCHEMAS
from towerlens.sinks.writers import conform, declare_table, load_table

from .conftest import SF_SMALL


def read_json(folder):
    (path,) = glob.glob(f"{folder}/part-*.json")
    with open(path) as fh:
        return json.loads(fh.readline())


def test_pipeline_outputs(spark, scratch):
    rep = pipeline.run(spark, SF_SMALL, scratch)
    assert set(rep.timings) == {"land", "bronze", "silver", "gold", "load"}
    audit = read_json(f"{scratch}/bronze/_ingestion_audit")
    # file inventory of the landed raw zone: bytes and checksum of the files
    towers_files = sorted(glob.glob(f"{scratch}/landing/cell_towers.csv/*.csv"))
    tw = audit["sources"][2]
    assert tw["file_count"] == len(towers_files)
    assert tw["size_bytes"] == sum(os.path.getsize(f) for f in towers_files)
    assert len(tw["checksum_sha256_16"]) == 16 and tw["malformed_fields"] == 0
    assert [s["filename"] for s in audit["sources"]] == [
        "telco_customer_churn.csv", "cdr_records.csv", "cell_towers.csv"]
    assert audit["sources"][0]["column_count"] == 21 and audit["stage"] == "bronze"
    assert audit["sources"][0]["null_counts"]["Dependents"] > 0
    gold, silver = pipeline.current(spark, f"{scratch}/gold"), pipeline.current(spark, f"{scratch}/silver")
    dq = read_json(f"{silver}/_data_quality_report")
    assert dq["referential_integrity"]["cdr_customer_match_rate_pct"] >= 99.9
    assert dq["customers"]["row_count"] == dq["customers"]["unique_customer_ids"]
    assert set(dq["cell_towers"]["technology_distribution"]) <= {"4G", "5G", "3G"}
    assert spark.table("towerlens.fact_regional_performance").count() == rep.counts["fact_regional_performance"]
    for name in MART_SCHEMAS:
        assert spark.read.parquet(f"{gold}/{name}").schema == MART_SCHEMAS[name]
        assert glob.glob(f"{gold}/csv/{name}/part-*.csv")
    # gold CSV exports scan back with the declared schema (dates parsed)
    from towerlens.sources import read_mart_csv
    for name, schema in MART_SCHEMAS.items():
        csv = read_mart_csv(spark, f"{gold}/csv/{name}", schema)
        pq = spark.read.parquet(f"{gold}/{name}").select(*schema.fieldNames())
        assert csv.exceptAll(pq).count() == 0 and pq.exceptAll(csv).count() == 0, name
    served = Warehouse.from_path(spark, scratch)
    assert served.serve()["fact_customer_summary"] == rep.counts["fact_customer_summary"]
    # every written table equals the lazily derived one (landing round trip,
    # staging, publish and conform change no value)
    lazy = Warehouse.from_sources(spark, SF_SMALL)
    for attr in ("customers", "cdrs", "towers", "customer_summary", "daily", "regional", "cohort"):
        a, b = getattr(served, attr), getattr(lazy, attr)
        b = b.select(*a.columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, attr


def test_gate_blocks_publish(spark, scratch):
    """Customers missing -> CDR match rate below 99.9 % -> nothing published."""
    w = Warehouse.from_sources(spark, SF_SMALL)
    w.customers_raw = w.customers_raw.where(F.col("customerID").cast("int") % 2 == 0)
    with pytest.raises(DataQualityError):
        pipeline.run_silver(spark, w, scratch, "2026-05-26T00:00:00Z")
    assert not os.path.exists(f"{scratch}/silver/_published")


def test_conform_and_declared_load(spark, scratch):
    w = Warehouse.from_sources(spark, SF_SMALL)
    partial = w.customer_summary.drop("total_sms", "avg_call_duration_sec")
    conformed = conform(partial, FACT_CUSTOMER_SUMMARY, {"total_sms": 0, "avg_call_duration_sec": 0.0})
    assert [(f.name, f.dataType) for f in conformed.schema] == [
        (f.name, f.dataType) for f in FACT_CUSTOMER_SUMMARY]
    assert conformed.where("total_sms != 0").count() == 0
    declare_table(spark, "tl_test_summary", FACT_CUSTOMER_SUMMARY, f"{scratch}/tbl")
    n = load_table(spark, "tl_test_summary", partial, FACT_CUSTOMER_SUMMARY, {"total_sms": 0})
    assert n == w.customer_summary.count()
    assert load_table(spark, "tl_test_summary", partial, FACT_CUSTOMER_SUMMARY, {"total_sms": 0}) == n


def test_failed_gold_gate_keeps_the_old_version(spark, scratch, monkeypatch):
    """Marts that break a rule are never published; registered queries still run after a pipeline run."""
    from towerlens.plans import gold
    from towerlens.plans.registry import QUERIES
    QUERIES["q01_executive_kpis"](spark, SF_SMALL).collect()
    pipeline.run(spark, SF_SMALL, scratch)
    before = pipeline.current(spark, f"{scratch}/gold")
    daily = gold.fact_daily_network_metrics
    monkeypatch.setattr(gold, "fact_daily_network_metrics", lambda cdrs: daily(cdrs).unionByName(daily(cdrs)))
    with pytest.raises(DataQualityError):
        pipeline.run_gold(spark, scratch)
    assert pipeline.current(spark, f"{scratch}/gold") == before
    assert spark.read.parquet(f"{before}/fact_daily_network_metrics").count() > 0
    assert QUERIES["q02_churn_by_contract"](spark, SF_SMALL).count() == 3
