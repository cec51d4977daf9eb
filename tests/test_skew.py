"""A third of all CDRs on one customer, one tower, one day and one call id
(a group of copies): every mart still equals the DuckDB oracle fed the same
derivation."""

import duckdb
import pytest
from pyspark.sql import functions as F

from towerlens.plans import oracle
from towerlens.plans.registry import ACTIVE_SQL, ORACLE, QUERIES, _WAREHOUSES  # noqa: F401
from towerlens.plans.warehouse import Warehouse

from .test_entry import canon

SF = "/root/testdata/sf0.001"
HOT = "l_partkey % 3 = 0"


def skew_spark(df):
    hot = (F.col("ord1") % 3) == 0
    return df.select(
        F.when(hot, F.lit("HOT-1")).otherwise(F.col("call_id")).alias("call_id"),
        F.when(hot, F.lit("0")).otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(hot, F.lit("1996-06-01T14:30:00")).otherwise(F.col("timestamp")).alias("timestamp"),
        *[c for c in df.columns if c not in ("call_id", "customer_id", "timestamp", "cell_tower_id")],
        F.when(hot, F.lit("1")).otherwise(F.col("cell_tower_id")).alias("cell_tower_id"),
    ).select(*df.columns)


SKEW_SQL = f"""
SELECT CASE WHEN {HOT} THEN 'HOT-1' ELSE call_id END AS call_id,
  CASE WHEN {HOT} THEN '0' ELSE customer_id END AS customer_id,
  CASE WHEN {HOT} THEN '1996-06-01T14:30:00' ELSE timestamp END AS timestamp,
  call_type, duration_seconds, bytes_transferred,
  CASE WHEN {HOT} THEN '1' ELSE cell_tower_id END AS cell_tower_id,
  call_status, cost_usd, ord0, ord1, ord2, ord3, ord4
FROM (SELECT *, ord1 AS l_partkey FROM cdrs_raw_base)"""


@pytest.fixture(scope="module")
def skewed(spark):
    w = Warehouse.from_sources(spark, SF, rank_parts=30)
    w.cdrs_raw = skew_spark(w.cdrs_raw)
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    base_sql, base_deps = oracle.CTES["cdrs_raw"]
    saved = dict(oracle.CTES)
    oracle.CTES["cdrs_raw_base"] = (base_sql, base_deps)
    oracle.CTES["cdrs_raw"] = (SKEW_SQL, ["cdrs_raw_base"])
    yield w, con
    oracle.CTES.clear()
    oracle.CTES.update(saved)


@pytest.mark.parametrize("mart,attr", [
    ("fact_customer_summary", "customer_summary"), ("fact_daily_network_metrics", "daily"),
    ("fact_regional_performance", "regional"), ("fact_churn_cohort", "cohort"), ("s_cdrs", "cdrs")])
def test_skewed_marts_match_oracle(skewed, mart, attr):
    w, con = skewed
    sdf = getattr(w, attr)
    got = sdf.toArrow()
    want = con.sql(oracle.with_ctes(f"SELECT * FROM {mart}", [mart])).to_arrow_table()
    assert got.num_rows == want.num_rows
    assert canon(got.to_pandas()) == canon(want.to_pandas())


def test_hot_key_really_is_a_third(skewed):
    w, _ = skewed
    raw = w.cdrs_raw
    share = raw.where("call_id = 'HOT-1'").count() / raw.count()
    assert 0.3 < share < 0.37


def test_active_customers_and_orphans_under_skew(skewed):
    from towerlens.plans import dq, gold
    w, con = skewed
    enriched = "SELECT call_id, customer_id, cell_tower_id, region, city, technology FROM cdr_enriched"
    strays = "SELECT * FROM s_cdrs c WHERE NOT EXISTS (SELECT 1 FROM s_towers t WHERE t.cell_tower_id = c.cell_tower_id)"
    cases = [(gold.active_customers(gold.activity_bitmaps(w.cdrs, w.towers)), ACTIVE_SQL, ["s_cdrs", "cdr_enriched"]),
             (gold.cdr_tower_enrich(w.cdrs, w.towers).select("call_id", "customer_id", "cell_tower_id", "region", "city", "technology"), enriched, ["cdr_enriched"]),
             (dq.dq_orphan_cdrs(w.cdrs, w.towers, key="cell_tower_id"), strays, ["s_cdrs", "s_towers"])]
    for sdf, sql, needs in cases:
        got, want = sdf.toArrow(), con.sql(oracle.with_ctes(sql, needs)).to_arrow_table()
        assert got.num_rows == want.num_rows > 0, sql
        assert canon(got.to_pandas()) == canon(want.to_pandas()), sql
