"""Registered queries: name -> Spark builder (spark, sf_dir) -> DataFrame,
and name -> oracle SQL (DuckDB) where the result is expressible in SQL.

Every builder derives its input from the driver tables at ``sf_dir`` and runs
over whole tables; LIMIT appears only where top-k is the query's feature.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from towerlens.constants import (
    MAX_CALL_SECONDS,
    SOURCES,
)
from towerlens.functions import eq_flag, lenient_number, lenient_timestamp, round_half_even
from towerlens.operators import (
    constraint_violations,
    dedup_counts,
    dedup_keep_first,
    pct_rank_average,
    table_fingerprint,
)
from towerlens.operators.constraints import TableConstraints
from towerlens.plans import analytics as A
from towerlens.plans import bronze, dq
from towerlens.plans import dashboards as D
from towerlens.plans import gold, oracle
from towerlens.plans.oracle import avgx, dbl, left_case, pct_rank_sql, re_, right_bins, ru, sumx, with_ctes
from towerlens.plans.warehouse import Warehouse
from towerlens.schemas import CDRS_RAW, CONSTRAINTS, CUSTOMERS_RAW, MART_SCHEMAS, TOWERS_RAW
from towerlens.session import checkpoint_dir, materialize, release
from towerlens.sinks.buckets import write_bucketed
from towerlens.sources.adapters import CDR_ORDER, CUSTOMER_ORDER, TOWER_ORDER

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}

_WAREHOUSES: dict[tuple[str, str], Warehouse] = {}

def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """One lazily built warehouse per (application, input folder)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = Warehouse.from_sources(spark, sf_dir)
    return _WAREHOUSES[key]

def register(name: str, sql: str | None = None, needs: list[str] | None = None):
    def deco(fn: Callable[[SparkSession, Warehouse], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: fn(spark, warehouse(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = with_ctes(sql, needs or [])
        return fn
    return deco

# ------------------------------------------------------------- bronze audit
_RAW_COLS = {
    "telco_customer_churn.csv": ("customers_raw", [f.name for f in CUSTOMERS_RAW.fields]),
    "cdr_records.csv": ("cdrs_raw", [f.name for f in CDRS_RAW.fields]),
    "cell_towers.csv": ("towers_raw", [f.name for f in TOWERS_RAW.fields]),
}
_RAW_ALL = ["customers_raw", "cdrs_raw", "towers_raw"]

def _sql_audit_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT '{fn}' AS filename, '{key}' AS key_column, COUNT(*) AS row_count, "
        f"CAST({len(_RAW_COLS[fn][1])} AS INTEGER) AS column_count FROM {_RAW_COLS[fn][0]}"
        for fn, _, key in SOURCES)

@register("audit_row_counts", _sql_audit_rows(), _RAW_ALL)
def _audit_row_counts(spark, w):
    return bronze.audit_row_counts(w.raw_sources())

@register("audit_null_counts", " UNION ALL ".join(
    f"SELECT '{fn}' AS filename, '{c}' AS column_name, COUNT(*) FILTER (WHERE \"{c}\" IS NULL) AS null_count "
    f"FROM {_RAW_COLS[fn][0]}" for fn, _, _ in SOURCES for c in _RAW_COLS[fn][1]), _RAW_ALL)
def _audit_null_counts(spark, w):
    return bronze.audit_null_counts(w.raw_sources())

@register("audit_total_rows", f"SELECT COUNT(*) AS total_sources, CAST(SUM(row_count) AS BIGINT) AS total_rows "
          f"FROM ({_sql_audit_rows()})", _RAW_ALL)
def _audit_total_rows(spark, w):
    return bronze.audit_total_rows(w.raw_sources())

_PRINTED = ["call_id", "customer_id", "call_type", "duration_seconds", "bytes_transferred", "cell_tower_id", "call_status"]

@register("table_fingerprint", "SELECT COUNT(*) AS row_count, CAST(SUM(CAST(('0x' || substr(md5(" + " || chr(31) || ".join(
    f"COALESCE(CAST({c} AS VARCHAR), chr(30))" for c in _PRINTED)
    + "), 1, 15)) AS BIGINT)) AS VARCHAR) AS hash_sum FROM s_cdrs", ["s_cdrs"])
def _table_fingerprint(spark, w):
    return table_fingerprint(w.cdrs, _PRINTED)

@register("scan_csv_towers", "SELECT * EXCLUDE (file_row) FROM towers_raw", ["towers_raw"])
def _scan_csv_towers(spark, w):
    """Write the tower source as CSV (shared checkpoint folder), scan it back
    with the declared schema (no inference pass)."""
    from towerlens.sinks import write_csv
    from towerlens.sources import read_csv
    root = checkpoint_dir(spark)
    if root is None:
        raise RuntimeError("spark.checkpoint.dir is not set")
    path = f"{root}/csv/cell_towers_{uuid.uuid4().hex}"
    write_csv(w.towers_raw.drop(*TOWER_ORDER), path)
    return read_csv(spark, path, TOWERS_RAW)

_HASHED = ["cell_tower_id", "region", "city", "technology", "installation_date", "capacity_users"]

@register("file_audit", f"""
SELECT * FROM (WITH lines AS (SELECT '{','.join(_HASHED)}' || chr(10) AS line, -1 AS n
  UNION ALL SELECT concat_ws(',', {', '.join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in _HASHED)}) || chr(10), file_row FROM towers_raw),
file AS (SELECT string_agg(line, '' ORDER BY n) AS body FROM lines),
leaves AS (SELECT i, sha256(substr(body, i * 1000 + 1, 1000)) AS d, len(body) AS n FROM (SELECT body, unnest(range(CAST(ceil(len(body) / 1000.0) AS BIGINT))) AS i FROM file))
SELECT CAST(1 AS BIGINT) AS file_count, CAST(max(n) AS BIGINT) AS size_bytes, substr(CASE WHEN COUNT(*) = 1 THEN max(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END, 1, 16) AS checksum_sha256_16 FROM leaves)""",
          ["towers_raw"])
def _file_audit(spark, w):
    """The tower source as one CSV file, audited in ranges of 1,000 bytes."""
    from towerlens.sinks import write_csv
    from towerlens.sources import source_file_stats
    path = f"{checkpoint_dir(spark)}/csv/audited_{uuid.uuid4().hex}"
    write_csv(w.towers_raw.orderBy("file_row").select(*_HASHED).coalesce(1), path)
    return source_file_stats(spark, path, block=1000)

@register("malformed_rows", """
SELECT customerID AS customer_id, 'TotalCharges' AS column_name, TotalCharges AS field_text, CAST(NULL AS DOUBLE) AS totalcharges FROM customers_raw
WHERE TotalCharges IS NOT NULL AND TRY_CAST(trim(TotalCharges) AS DOUBLE) IS NULL""", ["customers_raw"])
def _malformed_rows(spark, w):
    """Fields of the landed customers that are no number, with their text, from the scan that types them."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    from towerlens.sinks import write_csv
    from towerlens.sources import read_csv
    path = f"{checkpoint_dir(spark)}/csv/customers_{uuid.uuid4().hex}"
    write_csv(w.customers_raw.select("customerID", "TotalCharges", "tenure"), path)
    typed = StructType([f if f.name != "TotalCharges" else StructField(f.name, DoubleType()) for f in CUSTOMERS_RAW.fields
                        if f.name in ("customerID", "TotalCharges", "tenure")])
    bad = read_csv(spark, path, typed, rescued="rescued").where(F.col("rescued").isNotNull())
    return bad.select(F.col("customerID").alias("customer_id"), F.explode("rescued").alias("column_name", "field_text"), F.col("TotalCharges").alias("totalcharges"))

# ----------------------------------------------------------- silver pieces
@register("lenient_cast_number", """
SELECT customerID AS customer_id, TotalCharges AS totalcharges_text,
  TRY_CAST(trim(TotalCharges) AS DOUBLE) AS totalcharges_num FROM customers_raw""", ["customers_raw"])
def _lenient(spark, w):
    return w.customers_raw.select(F.col("customerID").alias("customer_id"),
                                  F.col("TotalCharges").alias("totalcharges_text"),
                                  lenient_number("TotalCharges").alias("totalcharges_num"))

@register("impute_total_charges", "SELECT customer_id, tenure, monthlycharges, totalcharges FROM s_customers",
          ["s_customers"])
def _impute(spark, w):
    return w.customers.select("customer_id", "tenure", "monthlycharges", "totalcharges")

@register("flag_columns", """
SELECT call_id, call_status, COALESCE(CAST(call_status = 'COMPLETED' AS INTEGER), 0) AS is_completed,
  COALESCE(CAST(call_status = 'DROPPED' AS INTEGER), 0) AS is_dropped FROM cdrs_raw""", ["cdrs_raw"])
def _flags(spark, w):
    return w.cdrs_raw.select("call_id", "call_status", eq_flag("call_status", "COMPLETED").alias("is_completed"),
                             eq_flag("call_status", "DROPPED").alias("is_dropped"))

@register("tenure_cohort", "SELECT customer_id, tenure, tenure_cohort FROM s_customers", ["s_customers"])
def _tenure_cohort(spark, w):
    return w.customers.select("customer_id", "tenure", "tenure_cohort")

@register("clean_customers", "SELECT * FROM s_customers", ["s_customers"])
def _clean_customers(spark, w):
    return w.customers

@register("clean_cdrs", "SELECT * FROM s_cdrs", ["s_cdrs"])
def _clean_cdrs(spark, w):
    return w.cdrs

@register("cdr_time_dims", "SELECT call_id, timestamp, call_date, call_hour, day_of_week FROM s_cdrs", ["s_cdrs"])
def _time_dims(spark, w):
    return w.cdrs.select("call_id", "timestamp", "call_date", "call_hour", "day_of_week")

@register("cdr_data_mb", "SELECT call_id, bytes_transferred, data_mb FROM s_cdrs", ["s_cdrs"])
def _data_mb(spark, w):
    return w.cdrs.select("call_id", "bytes_transferred", "data_mb")

def _parsed(w: Warehouse) -> DataFrame:
    return w.cdrs_raw.withColumn("timestamp", lenient_timestamp("timestamp")).dropna(subset=["timestamp"])

@register("outlier_filter", "SELECT call_id, duration_seconds FROM cdrs_filtered", ["cdrs_filtered"])
def _outlier_filter(spark, w):
    from towerlens.operators import outlier_filter
    return outlier_filter(_parsed(w), "duration_seconds", MAX_CALL_SECONDS).select("call_id", "duration_seconds")

@register("outlier_removed_count", """
SELECT COUNT(*) AS rows_in, COUNT(*) FILTER (WHERE duration_seconds <= 86400) AS rows_kept,
  COUNT(*) - COUNT(*) FILTER (WHERE duration_seconds <= 86400) AS rows_removed
FROM cdrs_parsed WHERE timestamp IS NOT NULL""", ["cdrs_parsed"])
def _outlier_count(spark, w):
    """The operator's own counters: its Observation, filled when the filtered rows are read once."""
    from towerlens.operators import outlier_filter
    seen = Observation("outlier_counts")
    outlier_filter(_parsed(w), "duration_seconds", MAX_CALL_SECONDS, seen).write.format("noop").mode("overwrite").save()
    n = seen.get
    return spark.createDataFrame([(n["rows_in"], n["rows_kept"], n["rows_in"] - n["rows_kept"])],
                                 "rows_in bigint, rows_kept bigint, rows_removed bigint")

@register("dedup_keep_first", """
SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY call_id
  ORDER BY ord0 NULLS FIRST, ord1 NULLS FIRST, ord2 NULLS FIRST, ord3 NULLS FIRST, ord4 NULLS FIRST) AS _rn
  FROM cdrs_raw) WHERE _rn = 1""", ["cdrs_raw"])
def _dedup(spark, w):
    return dedup_keep_first(w.cdrs_raw, ["call_id"], CDR_ORDER)

@register("dedup_customers", """
SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY customerID ORDER BY file_row NULLS FIRST) AS _rn
  FROM customers_raw) WHERE _rn = 1""", ["customers_raw"])
def _dedup_customers(spark, w):
    return dedup_keep_first(w.customers_raw, ["customerID"], CUSTOMER_ORDER)

@register("dedup_counts", """
SELECT COUNT(*) AS rows_in, COUNT(DISTINCT call_id) + LEAST(COUNT(*) FILTER (WHERE call_id IS NULL), 1) AS rows_out
FROM cdrs_raw""", ["cdrs_raw"])
def _dedup_counts(spark, w):
    return dedup_counts(w.cdrs_raw, "call_id")

@register("dim_cell_towers", "SELECT * FROM s_towers", ["s_towers"])
def _dim_towers(spark, w):
    return w.dim_cell_towers

@register("cdr_tower_enrich", "SELECT call_id, customer_id, cell_tower_id, region, city, technology FROM cdr_enriched",
          ["cdr_enriched"])
def _enrich(spark, w):
    return gold.cdr_tower_enrich(w.cdrs, w.towers).select(
        "call_id", "customer_id", "cell_tower_id", "region", "city", "technology")

# ---------------------------------------------------------------- gold marts
@register("fact_customer_summary", "SELECT * FROM fact_customer_summary", ["fact_customer_summary"])
def _summary(spark, w):
    return w.customer_summary

@register("fact_daily_network_metrics", "SELECT * FROM fact_daily_network_metrics", ["fact_daily_network_metrics"])
def _daily(spark, w):
    return w.daily

@register("fact_regional_performance", "SELECT * FROM fact_regional_performance", ["fact_regional_performance"])
def _regional(spark, w):
    return w.regional

ACTIVE_SQL = """
SELECT 'day' AS level, CAST(call_date AS VARCHAR) AS period, COUNT(DISTINCT customer_id) AS unique_customers
FROM s_cdrs WHERE call_date IS NOT NULL AND customer_id IS NOT NULL GROUP BY call_date
UNION ALL SELECT 'month', strftime(call_date, '%Y-%m'), COUNT(DISTINCT customer_id)
FROM s_cdrs WHERE call_date IS NOT NULL AND customer_id IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'region', region, COUNT(DISTINCT customer_id) FROM cdr_enriched
WHERE region IS NOT NULL AND customer_id IS NOT NULL GROUP BY region
UNION ALL SELECT 'all', 'all', COUNT(DISTINCT customer_id) FROM s_cdrs"""

@register("active_customers", ACTIVE_SQL, ["s_cdrs", "cdr_enriched"])
def _active_customers(spark, w):
    return gold.active_customers(gold.activity_bitmaps(w.cdrs, w.towers))

@register("fact_churn_cohort", "SELECT * FROM fact_churn_cohort", ["fact_churn_cohort"])
def _cohort(spark, w):
    return w.cohort

@register("pct_rank_average", f"""
SELECT customer_id, total_data_mb, {pct_rank_sql('total_data_mb')} AS pct_total_data_mb FROM summary_base""",
          ["summary_base"])
def _pct_rank(spark, w):
    base = gold.customer_summary_base(w.customers, w.cdrs).select("customer_id", "total_data_mb")
    return pct_rank_average(base, "total_data_mb", "pct_total_data_mb")

@register("engagement_score", "SELECT customer_id, engagement_score, estimated_clv_usd FROM fact_customer_summary",
          ["fact_customer_summary"])
def _engagement(spark, w):
    return w.customer_summary.select("customer_id", "engagement_score", "estimated_clv_usd")

# ------------------------------------------------------------ data quality
@register("dq_customers", f"""
SELECT COUNT(*) AS row_count, COUNT(DISTINCT customer_id) AS unique_customer_ids,
  COUNT(*) FILTER (WHERE totalcharges IS NULL) AS null_total_charges,
  {re_('AVG(churn_flag) * 100', 2)} AS churn_rate_pct FROM s_customers""", ["s_customers"])
def _dq_customers(spark, w):
    return dq.dq_customers(w.customers)

@register("dq_cdrs", f"""
SELECT COUNT(*) AS row_count, COUNT(DISTINCT call_id) AS unique_call_ids,
  {re_('AVG(is_completed) * 100', 2)} AS completed_calls_pct,
  {re_('AVG(is_dropped) * 100', 2)} AS dropped_calls_pct,
  CAST(MIN(timestamp) AS VARCHAR) AS date_range_min, CAST(MAX(timestamp) AS VARCHAR) AS date_range_max
FROM s_cdrs""", ["s_cdrs"])
def _dq_cdrs(spark, w):
    return dq.dq_cdrs(w.cdrs)

def _match_sql(key: str, dim: str) -> str:
    matched = f"(SELECT COUNT(*) FROM s_cdrs WHERE {key} IN (SELECT {key} FROM {dim} WHERE {key} IS NOT NULL))"
    return re_(f"{dbl(matched)} / (SELECT COUNT(*) FROM s_cdrs) * 100", 2)

@register("dq_referential_integrity", f"""
SELECT {_match_sql('customer_id', 's_customers')} AS cdr_customer_match_rate_pct,
  {_match_sql('cell_tower_id', 's_towers')} AS cdr_tower_match_rate_pct""", ["s_cdrs", "s_customers", "s_towers"])
def _dq_ri(spark, w):
    return dq.dq_referential_integrity(w.cdrs, w.customers, w.towers)

@register("bucketed_customer_match", f"""
SELECT {_match_sql('customer_id', 's_customers')} AS cdr_customer_match_rate_pct""", ["s_customers", "s_cdrs"])
def _bucketed_match(spark, w):
    root = f"{checkpoint_dir(spark)}/tables/bucketed-{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    customers = write_bucketed(w.customers, f"{root}/customers", "customer_id", parts)
    activity = write_bucketed(gold.cdrs_by_customer(w.cdrs), f"{root}/customer_activity", "customer_id", parts)
    return gold.customer_match(activity, customers).select(
        round_half_even("customer_id_match_pct", 2).alias("cdr_customer_match_rate_pct"))

@register("dq_orphan_cdrs", """
SELECT * FROM s_cdrs c WHERE NOT EXISTS (SELECT 1 FROM s_customers k WHERE k.customer_id = c.customer_id)""",
          ["s_cdrs", "s_customers"])
def _dq_orphans(spark, w):
    return dq.dq_orphan_cdrs(w.cdrs, w.customers)

@register("dq_orphan_cdrs_tower", """
SELECT * FROM s_cdrs c WHERE NOT EXISTS (SELECT 1 FROM s_towers t WHERE t.cell_tower_id = c.cell_tower_id)""",
          ["s_cdrs", "s_towers"])
def _dq_orphans_tower(spark, w):
    return dq.dq_orphan_cdrs(w.cdrs, w.towers, key="cell_tower_id")


@register("dq_towers", "SELECT COUNT(*) AS row_count, COUNT(DISTINCT region) AS unique_regions FROM s_towers",
          ["s_towers"])
def _dq_towers(spark, w):
    return dq.dq_towers(w.towers)

@register("dq_technology_distribution", """
SELECT technology, COUNT(*) AS tower_count FROM s_towers WHERE technology IS NOT NULL
GROUP BY technology ORDER BY tower_count DESC, technology""", ["s_towers"])
def _dq_tech(spark, w):
    return dq.dq_technology_distribution(w.towers)

@register("dq_report", f"""
SELECT '1970-01-01T00:00:00Z' AS run_timestamp, c.row_count AS customers_rows, c.unique_ids AS customers_unique,
  c.churn AS churn_rate_pct, k.row_count AS cdrs_rows, k.unique_ids AS cdrs_unique, k.first_day AS date_range_min,
  {_match_sql('customer_id', 's_customers')} AS cdr_customer_match_rate_pct,
  {_match_sql('cell_tower_id', 's_towers')} AS cdr_tower_match_rate_pct,
  t.row_count AS towers_rows, t.n4 AS towers_4g, t.n5 AS towers_5g
FROM (SELECT COUNT(*) AS row_count, COUNT(DISTINCT customer_id) AS unique_ids, {re_('AVG(churn_flag) * 100', 2)} AS churn FROM s_customers) c,
  (SELECT COUNT(*) AS row_count, COUNT(DISTINCT call_id) AS unique_ids, CAST(MIN(timestamp) AS VARCHAR) AS first_day FROM s_cdrs) k,
  (SELECT COUNT(*) AS row_count, COUNT(*) FILTER (WHERE technology = '4G') AS n4,
     COUNT(*) FILTER (WHERE technology = '5G') AS n5 FROM s_towers) t""", ["s_customers", "s_cdrs", "s_towers"])
def _dq_report(spark, w):
    r = dq.dq_report(spark, w.customers, w.cdrs, w.towers, run_ts="1970-01-01T00:00:00Z")
    return r.select("run_timestamp", F.col("customers.row_count").alias("customers_rows"),
                    F.col("customers.unique_customer_ids").alias("customers_unique"), "customers.churn_rate_pct",
                    F.col("cdrs.row_count").alias("cdrs_rows"), F.col("cdrs.unique_call_ids").alias("cdrs_unique"),
                    "cdrs.date_range_min", "referential_integrity.*", F.col("cell_towers.row_count").alias("towers_rows"),
                    F.col("cell_towers.technology_distribution")["4G"].alias("towers_4g"),
                    F.col("cell_towers.technology_distribution")["5G"].alias("towers_5g"))

@register("dq_report_fields", f"""
SELECT '1970-01-01T00:00:00Z' AS run_timestamp, c.*, k.*,
  {_match_sql('customer_id', 's_customers')} AS referential_integrity_cdr_customer_match_rate_pct,
  {_match_sql('cell_tower_id', 's_towers')} AS referential_integrity_cdr_tower_match_rate_pct, t.*, d.technology, d.tower_count
FROM (SELECT COUNT(*) AS customers_row_count, COUNT(DISTINCT customer_id) AS customers_unique_customer_ids,
    COUNT(*) FILTER (WHERE totalcharges IS NULL) AS customers_null_total_charges,
    {re_('AVG(churn_flag) * 100', 2)} AS customers_churn_rate_pct FROM s_customers) c,
  (SELECT COUNT(*) AS cdrs_row_count, COUNT(DISTINCT call_id) AS cdrs_unique_call_ids,
    {re_('AVG(is_completed) * 100', 2)} AS cdrs_completed_calls_pct, {re_('AVG(is_dropped) * 100', 2)} AS cdrs_dropped_calls_pct,
    CAST(MIN(timestamp) AS VARCHAR) AS cdrs_date_range_min, CAST(MAX(timestamp) AS VARCHAR) AS cdrs_date_range_max FROM s_cdrs) k,
  (SELECT COUNT(*) AS cell_towers_row_count, COUNT(DISTINCT region) AS cell_towers_unique_regions FROM s_towers) t
  LEFT JOIN (SELECT technology, COUNT(*) AS tower_count FROM s_towers WHERE technology IS NOT NULL GROUP BY technology) d ON TRUE""",
          ["s_customers", "s_cdrs", "s_towers"])
def _dq_report_fields(spark, w):
    report = dq.dq_report(spark, w.customers, w.cdrs, w.towers, run_ts="1970-01-01T00:00:00Z")
    return dq.dq_report_fields(report, dq.dq_technology_distribution(w.towers))

def _constraint_sql(view: str, spec) -> list[str]:
    rows = []
    if spec.primary_key:
        ks = spec.primary_key
        present = " AND ".join(f"{k} IS NOT NULL" for k in ks)
        tup = ks[0] if len(ks) == 1 else "(" + ", ".join(ks) + ")"
        rows.append((f"primary_key({','.join(ks)})",
                     f"COUNT(*) - COUNT(DISTINCT CASE WHEN {present} THEN {tup} END)"))
    for c in spec.not_null:
        rows.append((f"not_null({c})", f"COUNT(*) FILTER (WHERE {c} IS NULL)"))
    for c, allowed in spec.allowed_values.items():
        lst = ", ".join(f"'{a}'" for a in allowed)
        rows.append((f"check({c} in ({','.join(allowed)}))", f"COUNT(*) FILTER (WHERE NOT ({c} IN ({lst})))"))
    for c, lo in spec.min_values.items():
        rows.append((f"min({c})>={lo}", f"COUNT(*) FILTER (WHERE {c} < {lo})"))
    return [f"SELECT '{spec.table}' AS table_name, '{name}' AS constraint_name, "
            f"CAST({expr} AS BIGINT) AS violations FROM {view}" for name, expr in rows]

#: The rules of the tables, stated here again for the oracle.
_RULES = [
    TableConstraints("customers", ("customer_id",), min_values={"monthlycharges": 0}),
    TableConstraints("dim_cell_towers", ("cell_tower_id",), ("region",), {"technology": ("4G", "5G", "3G")}),
    TableConstraints("fact_customer_summary", ("customer_id",), ("churn_flag",)),
    TableConstraints("fact_daily_network_metrics", ("call_date",), ("total_calls", "completed_calls", "dropped_calls", "unique_customers_active")),
    TableConstraints("fact_regional_performance", ("region",)),
    TableConstraints("fact_churn_cohort", ("tenure_cohort", "contract", "paymentmethod")),
]

_CONSTRAINT_VIEWS = {
    "customers": "s_customers", "dim_cell_towers": "s_towers",
    "fact_customer_summary": "fact_customer_summary",
    "fact_daily_network_metrics": "fact_daily_network_metrics",
    "fact_regional_performance": "fact_regional_performance", "fact_churn_cohort": "fact_churn_cohort",
}

@register("constraint_violations", " UNION ALL ".join(
    q for spec in _RULES for q in _constraint_sql(_CONSTRAINT_VIEWS[spec.table], spec)),
    list(_CONSTRAINT_VIEWS.values()))
def _constraints(spark, w):
    tables = {"customers": w.customers, "dim_cell_towers": w.towers,
              "fact_customer_summary": w.customer_summary, "fact_daily_network_metrics": w.daily,
              "fact_regional_performance": w.regional, "fact_churn_cohort": w.cohort}
    out = None
    for name, df in tables.items():
        v = constraint_violations(df, CONSTRAINTS[name])
        out = v if out is None else out.unionByName(v)
    return out

# ------------------------------------------------------------------- load
def _load(spark: SparkSession, w: Warehouse, marts: dict[str, DataFrame]) -> dict[str, str]:
    """Every mart loaded twice into a declared table of its own database: part of its rows, then all of them."""
    from towerlens.sinks import load_table
    database = f"towerlens_load_{uuid.uuid4().hex}"
    root = f"{checkpoint_dir(spark)}/load/{database}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}'")
    for name, df in marts.items():
        df = materialize(df, "mart_to_load")
        for rows in (df.limit(1), df):
            load_table(spark, f"{database}.{name}", rows, MART_SCHEMAS[name], root=f"{root}/{name}", check=CONSTRAINTS[name])
        release(df)
    return {name: f"{database}.{name}" for name in marts}

@register("load_daily_network_metrics", "SELECT * FROM fact_daily_network_metrics", ["fact_daily_network_metrics"])
def _load_daily(spark, w):
    """The rows of the declared table after a second load took the place of the first."""
    return spark.table(_load(spark, w, {"fact_daily_network_metrics": w.daily})["fact_daily_network_metrics"])

@register("load_row_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {v}" for t, v in (
    ("dim_cell_towers", "s_towers"), ("fact_customer_summary", "fact_customer_summary"), ("fact_regional_performance", "fact_regional_performance"),
    ("fact_churn_cohort", "fact_churn_cohort"))), ["s_towers", "fact_customer_summary", "fact_regional_performance", "fact_churn_cohort"])
def _load_counts(spark, w):
    """Rows read back from the declared tables."""
    tables = _load(spark, w, {"dim_cell_towers": w.towers, "fact_customer_summary": w.customer_summary,
                              "fact_regional_performance": w.regional, "fact_churn_cohort": w.cohort})
    parts = [spark.table(t).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, t in tables.items()]
    return reduce(DataFrame.unionByName, parts)

_RAW_SPEC = TableConstraints("customers_raw", primary_key=("customerID",), not_null=("Dependents",),
                             allowed_values={"Contract": ("One year", "Two year")}, min_values={"tenure": 6})

@register("constraint_violations_raw", """
SELECT 'customers_raw' AS table_name, name AS constraint_name, violations FROM (
  SELECT 'primary_key(customerID)' AS name, COUNT(*) - COUNT(DISTINCT customerID) AS violations FROM customers_raw
  UNION ALL SELECT 'not_null(Dependents)', COUNT(*) FILTER (WHERE Dependents IS NULL) FROM customers_raw
  UNION ALL SELECT 'check(Contract in (One year,Two year))', COUNT(*) FILTER (WHERE Contract = 'Month-to-month') FROM customers_raw
  UNION ALL SELECT 'min(tenure)>=6', COUNT(*) FILTER (WHERE tenure < 6) FROM customers_raw)""", ["customers_raw"])
def _constraints_raw(spark, w):
    """Rules that the raw source breaks, so that every count is above zero."""
    return constraint_violations(w.customers_raw, _RAW_SPEC)

# --------------------------------------------------------- business queries
FCS = ["fact_customer_summary"]
CHURN_PCT = ru("AVG(churn_flag) * 100", 2)

@register("q01_executive_kpis", f"""
SELECT COUNT(*) AS total_customers, CAST(SUM(churn_flag) AS BIGINT) AS churned_customers,
  {CHURN_PCT} AS churn_rate_pct, {ru(sumx('monthlycharges'), 2)} AS monthly_revenue_usd,
  {ru(avgx('monthlycharges'), 2)} AS arpu_usd, {ru(sumx('estimated_clv_usd'), 2)} AS total_clv_usd,
  {ru('AVG(tenure)', 1)} AS avg_tenure_months
FROM fact_customer_summary""", FCS)
def _q01(spark, w):
    return A.q01_executive_kpis(w.customer_summary)

@register("q02_churn_by_contract", f"""
SELECT contract, COUNT(*) AS customer_count, CAST(SUM(churn_flag) AS BIGINT) AS churned,
  {CHURN_PCT} AS churn_rate_pct, {ru(avgx('monthlycharges'), 2)} AS avg_monthly_charges,
  {ru('AVG(tenure)', 1)} AS avg_tenure_months
FROM fact_customer_summary GROUP BY contract ORDER BY churn_rate_pct DESC""", FCS)
def _q02(spark, w):
    return A.q02_churn_by_contract(w.customer_summary)

@register("q03_high_risk_segments", f"""
SELECT tenure_cohort, contract, paymentmethod, customer_count, churn_count, churn_rate_pct,
  {ru('avg_monthly_charges', 2)} AS avg_monthly_charges
FROM fact_churn_cohort WHERE customer_count >= {oracle.HIGH_RISK_MIN_CUSTOMERS}
ORDER BY churn_rate_pct DESC, tenure_cohort, contract, paymentmethod LIMIT 10""", ["fact_churn_cohort"])
def _q03(spark, w):
    return A.q03_high_risk_segments(w.cohort)

@register("q04_churn_by_internet", f"""
SELECT internetservice, COUNT(*) AS customers, CAST(SUM(churn_flag) AS BIGINT) AS churned,
  {CHURN_PCT} AS churn_rate_pct, {ru(avgx('monthlycharges'), 2)} AS arpu
FROM fact_customer_summary GROUP BY internetservice ORDER BY churn_rate_pct DESC""", FCS)
def _q04(spark, w):
    return A.q04_churn_by_internet(w.customer_summary)

AT_RISK_WHERE = (f"churn_flag = 0 AND contract = '{oracle.MONTH_TO_MONTH}' AND monthlycharges > {oracle.AT_RISK_MIN_MONTHLY}")

@register("q05_revenue_at_risk", f"""
SELECT tenure_cohort, contract, COUNT(*) AS at_risk_customer_count,
  {ru(sumx('monthlycharges'), 2)} AS monthly_revenue_at_risk_usd,
  {ru(sumx('estimated_clv_usd'), 2)} AS clv_at_risk_usd
FROM fact_customer_summary WHERE {AT_RISK_WHERE}
GROUP BY tenure_cohort, contract ORDER BY monthly_revenue_at_risk_usd DESC""", FCS)
def _q05(spark, w):
    return A.q05_revenue_at_risk(w.customer_summary)

@register("q06_network_by_region", f"""
SELECT region, total_calls, completed_calls, dropped_calls, drop_rate_pct,
  {ru(f"total_data_mb / {dbl(1024)}", 2)} AS total_data_gb, active_towers,
  {ru(f"total_calls * {dbl(1.0)} / active_towers", 1)} AS calls_per_tower, revenue_per_customer_usd
FROM fact_regional_performance ORDER BY total_calls DESC""", ["fact_regional_performance"])
def _q06(spark, w):
    return A.q06_network_by_region(w.regional)

@register("q07_daily_health_30", f"""
SELECT call_date, total_calls, drop_rate_pct, call_success_rate_pct, unique_customers_active,
  {ru(f"total_data_mb / {dbl(1024)}", 2)} AS data_gb, {ru('total_revenue_usd', 2)} AS revenue_usd
FROM fact_daily_network_metrics ORDER BY call_date DESC LIMIT 30""", ["fact_daily_network_metrics"])
def _q07(spark, w):
    return A.q07_daily_health_30(w.daily)

@register("q08_engagement_vs_churn", f"""
SELECT {left_case('engagement_score', oracle.ENGAGEMENT_SQL_EDGES, oracle.ENGAGEMENT_SQL_LABELS)} AS engagement_band,
  COUNT(*) AS customers, {CHURN_PCT} AS churn_rate_pct, {ru(avgx('monthlycharges'), 2)} AS avg_arpu,
  {ru(avgx('total_data_mb'), 2)} AS avg_data_mb, {ru('AVG(total_calls)', 1)} AS avg_calls
FROM fact_customer_summary GROUP BY engagement_band ORDER BY engagement_band""", FCS)
def _q08(spark, w):
    return A.q08_engagement_vs_churn(w.customer_summary)

@register("q09_payment_vs_churn", f"""
SELECT paymentmethod, COUNT(*) AS customers, {CHURN_PCT} AS churn_rate_pct,
  {ru(avgx('monthlycharges'), 2)} AS avg_arpu, {ru('AVG(tenure)', 1)} AS avg_tenure
FROM fact_customer_summary GROUP BY paymentmethod ORDER BY churn_rate_pct DESC""", FCS)
def _q09(spark, w):
    return A.q09_payment_vs_churn(w.customer_summary)

@register("q10_tenure_cohort_revenue", f"""
SELECT tenure_cohort, COUNT(*) AS customers, {CHURN_PCT} AS churn_rate_pct,
  {ru(sumx('monthlycharges'), 2)} AS monthly_revenue_usd, {ru(avgx('estimated_clv_usd'), 2)} AS avg_clv_usd
FROM fact_customer_summary GROUP BY tenure_cohort ORDER BY tenure_cohort""", FCS)
def _q10(spark, w):
    return A.q10_tenure_cohort_revenue(w.customer_summary)

@register("cohort_preview_top5", """
SELECT * FROM fact_churn_cohort ORDER BY churn_rate_pct DESC, tenure_cohort, contract, paymentmethod LIMIT 5""",
          ["fact_churn_cohort"])
def _preview(spark, w):
    return A.cohort_preview(w.cohort)


@register("ex1_having_form", f"""
SELECT contract, AVG(churn_flag) * 100 AS churn_rate_pct FROM fact_customer_summary
GROUP BY contract HAVING contract = '{oracle.MONTH_TO_MONTH}'""", FCS)
def _ex1h(spark, w):
    return A.ex1_having_form(w.customer_summary)

@register("ex1_where_form", f"""
SELECT contract, AVG(churn_flag) * 100 AS churn_rate_pct FROM fact_customer_summary
WHERE contract = '{oracle.MONTH_TO_MONTH}' GROUP BY contract""", FCS)
def _ex1w(spark, w):
    return A.ex1_where_form(w.customer_summary)

@register("ex2_preaggregated_distinct", "SELECT region, unique_customers FROM fact_regional_performance",
          ["fact_regional_performance"])
def _ex2(spark, w):
    return A.ex2_preaggregated_distinct(w.regional)

@register("ex3_topk_cohorts", f"""
SELECT tenure_cohort, contract, paymentmethod, churn_rate_pct FROM fact_churn_cohort
WHERE customer_count >= {oracle.HIGH_RISK_MIN_CUSTOMERS}
ORDER BY churn_rate_pct DESC, tenure_cohort, contract, paymentmethod LIMIT 10""", ["fact_churn_cohort"])
def _ex3(spark, w):
    return A.ex3_topk_cohorts(w.cohort)

@register("ex4_upper_predicate", f"SELECT * FROM fact_customer_summary WHERE UPPER(contract) = '{oracle.MONTH_TO_MONTH.upper()}'",
          FCS)
def _ex4u(spark, w):
    return A.ex4_upper_predicate(w.customer_summary)

@register("ex4_plain_predicate", f"SELECT * FROM fact_customer_summary WHERE contract = '{oracle.MONTH_TO_MONTH}'", FCS)
def _ex4p(spark, w):
    return A.ex4_plain_predicate(w.customer_summary)

@register("ex5_rank_in_cohort", """
SELECT customer_id, tenure_cohort, estimated_clv_usd, clv_rank_in_cohort FROM (
  SELECT customer_id, tenure_cohort, estimated_clv_usd,
    CAST(RANK() OVER (PARTITION BY tenure_cohort ORDER BY estimated_clv_usd DESC) AS INTEGER) AS clv_rank_in_cohort
  FROM fact_customer_summary WHERE churn_flag = 0)
ORDER BY tenure_cohort NULLS FIRST, clv_rank_in_cohort, customer_id LIMIT 50""", FCS)
def _ex5(spark, w):
    return A.ex5_rank_in_cohort(w.customer_summary)

@register("ex6_cte_at_risk", f"""
SELECT tenure_cohort, COUNT(*) AS at_risk_count, {sumx('monthlycharges')} AS monthly_revenue_at_risk
FROM fact_customer_summary WHERE {AT_RISK_WHERE}
GROUP BY tenure_cohort ORDER BY monthly_revenue_at_risk DESC""", FCS)
def _ex6(spark, w):
    return A.ex6_cte_at_risk(spark, w.customer_summary)

@register("v1_regional_snapshot", """
SELECT region, total_calls, drop_rate_pct, revenue_per_customer_usd FROM fact_regional_performance
ORDER BY total_calls DESC""", ["fact_regional_performance"])
def _v1(spark, w):
    return A.v1_regional_snapshot(spark, w.regional)

# --------------------------------------------------------------- dashboards
@register("d0_kpi_tiles", f"""
SELECT COUNT(*) AS total_customers, AVG(churn_flag) * 100 AS churn_rate, {sumx('monthlycharges')} AS mrr,
  {avgx('monthlycharges')} AS arpu,
  COALESCE({sumx('CASE WHEN churn_flag = 1 THEN monthlycharges END')}, {dbl(0)}) AS lost_mrr
FROM fact_customer_summary""", FCS)
def _d0(spark, w):
    return D.d0_kpi_tiles(w.customer_summary)

@register("d1_contract_churn", """
SELECT contract, AVG(churn_flag) * 100 AS churn_rate, COUNT(customer_id) AS customers
FROM fact_customer_summary WHERE contract IS NOT NULL GROUP BY contract ORDER BY churn_rate DESC""", FCS)
def _d1(spark, w):
    return D.d1_contract_churn(w.customer_summary)

_PAY_LABEL = ("replace(replace(replace(replace(paymentmethod, 'Bank transfer (automatic)', 'Bank xfer'), "
              "'Credit card (automatic)', 'Credit card'), 'Electronic check', 'E-check'), 'Mailed check', 'Mail check')")

@register("d2_top_cohorts", f"""
SELECT tenure_cohort, contract, paymentmethod, customer_count, churn_rate_pct,
  concat_ws(' | ', tenure_cohort, replace(contract, 'Month-to-month', 'M2M'), {_PAY_LABEL}) AS label
FROM (SELECT * FROM fact_churn_cohort WHERE customer_count >= {oracle.HIGH_RISK_MIN_CUSTOMERS}
      ORDER BY churn_rate_pct DESC, tenure_cohort, contract, paymentmethod LIMIT 8)
ORDER BY churn_rate_pct""", ["fact_churn_cohort"])
def _d2(spark, w):
    return D.d2_top_cohorts(w.cohort)

@register("d3_regional_sorted", """
SELECT region, total_calls, drop_rate_pct FROM fact_regional_performance ORDER BY total_calls DESC""",
          ["fact_regional_performance"])
def _d3(spark, w):
    return D.d3_regional_sorted(w.regional)

@register("d4_daily_success_trend", f"""
SELECT call_date, call_success_rate_pct,
  (SELECT {avgx('call_success_rate_pct')} FROM fact_daily_network_metrics) AS mean_success_rate_pct
FROM fact_daily_network_metrics ORDER BY call_date""", ["fact_daily_network_metrics"])
def _d4(spark, w):
    return D.d4_daily_success_trend(w.daily)

@register("d5_engagement_bands_right", f"""
SELECT eng_band, AVG(churn_flag) * 100 AS churn_rate, COUNT(customer_id) AS customers,
  {avgx('monthlycharges')} AS avg_revenue
FROM (SELECT *, {right_bins('engagement_score', oracle.ENGAGEMENT_DASH_EDGES, oracle.ENGAGEMENT_DASH_LABELS)} AS eng_band
      FROM fact_customer_summary)
WHERE eng_band IS NOT NULL GROUP BY eng_band ORDER BY eng_band""", FCS)
def _d5(spark, w):
    return D.d5_engagement_bands_right(w.customer_summary)

