"""The medallion pipeline as one Spark application: land raw sources as
files -> bronze audit of the files -> silver (write, audit, publish) -> gold
marts (write, gate, publish) -> warehouse load (declared tables) -> smoke query.

Silver and gold follow write-audit-publish: all tables of a layer are written
to a folder of their own version, the gates run on the written Parquet, and
only then is the version published, by one atomic call (``sinks.publish``).
Readers see all old or all new tables; a failed gate or a crash leaves the old
version current. The version that was current before is kept, older ones are
deleted. The load writes and gates fresh files and then switches each declared table to them.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from towerlens.constants import DEFAULT_AS_OF, SOURCES
from towerlens.operators import constraint_violations, enforce
from towerlens.operators.constraints import load_check
from towerlens.plans import bronze, dq, gold, silver
from towerlens.plans.analytics import v1_regional_snapshot
from towerlens.plans.warehouse import Warehouse
from towerlens.schemas import CONSTRAINTS, CUSTOMER_SUMMARY_DEFAULTS, MART_SCHEMAS
from towerlens.session import materialized, release_since, run_concurrently
from towerlens.sinks import write_csv, write_json_report, write_mart, write_parquet
from towerlens.sinks.buckets import forget_bucketed, read_bucketed, write_bucketed
from towerlens.sinks.publish import current, new_version, publish
from towerlens.sinks.writers import conform, load_table
from towerlens.sources import hadoop_fs, require_sources, source_file_stats
from towerlens.sources.adapters import CDR_ORDER, CUSTOMER_ORDER, TOWER_ORDER


def step(spark: SparkSession, name: str) -> None:
    """Label the following Spark jobs (visible in the event log)."""
    spark.sparkContext.setJobDescription(name)


@dataclass
class RunReport:
    timings: dict[str, float] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)


def run_land(spark: SparkSession, w: Warehouse, out: str) -> dict[str, str]:
    """Write the three raw sources once as CSV files: the raw zone that the
    bronze audit inventories and silver cleans (the CDR file keeps its row
    order as columns)."""
    paths = {name: f"{out}/landing/{name}" for name, _, _ in SOURCES}
    frames = {"telco_customer_churn.csv": w.customers_raw, "cdr_records.csv": w.cdrs_raw,
              "cell_towers.csv": w.towers_raw}
    run_concurrently(spark, {f"land: {n}": (lambda n=n: write_csv(frames[n], paths[n])) for n in paths})
    return paths


def run_bronze(spark: SparkSession, w: Warehouse, out: str, run_ts: str,
               paths: dict[str, str] | None = None) -> DataFrame:
    """Inventory of the raw sources: row, column and NULL counts per source
    and, for landed files, malformed fields (by the same scan), file count, bytes and checksum (one read of the bytes)."""
    step(spark, "bronze: audit sources")
    if paths:
        require_sources(spark, paths)
    stats = {name: source_file_stats(spark, path) for name, path in paths.items()} if paths else None
    audit = bronze.audit_landed(spark, paths) if paths else bronze.audit_sources(w.raw_sources())
    write_json_report(bronze.audit_document(spark, audit, run_ts, stats), f"{out}/bronze/_ingestion_audit")
    return audit


def run_silver(spark: SparkSession, w: Warehouse, out: str, run_ts: str,
               cdr_partition_by: str | None = None, buckets: int | None = None) -> dict[str, int]:
    """Clean, write, audit and publish the silver tables: customers, CDRs, towers, and the CDRs by customer.

    Customers and CDRs by customer have one row a key and are bucketed by it (``sinks.buckets``; default: as many
    buckets as the session has shuffle partitions).
    """
    obs, written = Observation("outliers"), Observation("cdrs written")
    version = new_version()
    stage = f"{out}/silver/{version}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Every mart aggregates all CDRs, so folders per date would only add
    # files; rows sorted by (call_date, customer_id) inside each file make
    # Parquet min/max statistics selective for date or customer predicates.
    # The report's measures of the CDRs that add up are observed by the task that writes the rows.
    measured = [c.alias(name) for name, (_, c) in dq.cdr_metrics().items()]
    run_concurrently(spark, {
        "silver: write cdrs": lambda: write_parquet(
            silver.clean_cdrs(w.cdrs_raw, CDR_ORDER, observation=obs).observe(written, *measured), f"{stage}/cdrs",
            partition_by=cdr_partition_by, cluster_by=["call_date", "customer_id"]),
        "silver: write customers": lambda: write_bucketed(
            silver.clean_customers(w.customers_raw, CUSTOMER_ORDER), f"{stage}/customers", "customer_id", buckets),
        "silver: write towers": lambda: write_parquet(silver.clean_cell_towers(w.towers_raw, w.as_of, TOWER_ORDER), f"{stage}/cell_towers"),
    })
    s_customers = read_bucketed(spark, f"{stage}/customers")
    s_cdrs = spark.read.parquet(f"{stage}/cdrs")
    s_towers = spark.read.parquet(f"{stage}/cell_towers")
    step(spark, "silver: write cdrs by customer")
    s_activity = write_bucketed(gold.cdrs_by_customer(s_cdrs), f"{stage}/customer_activity", "customer_id", buckets)
    # audit on the staged tables, then publish
    lazy = dq.dq_report(spark, s_customers, s_cdrs, s_towers, run_ts, observed=written.get, by_customer=s_activity)
    checks = run_concurrently(spark, {
        "silver: constraints": lambda: constraint_violations(s_customers, CONSTRAINTS["customers"]).collect(),
        "silver: dq report": lambda: lazy.collect(),
    })
    enforce(checks["silver: constraints"])
    report = spark.createDataFrame(checks["silver: dq report"], lazy.schema)  # one row
    dq.gate(report)
    step(spark, "silver: publish")
    write_json_report(report, f"{stage}/_data_quality_report")
    dq.dq_technology_distribution(s_towers).write.json(f"{stage}/_technology_distribution")
    publish(spark, f"{out}/silver", version)
    forget_bucketed(spark, f"{stage}/customers", f"{stage}/customer_activity")
    m = obs.get
    return {"cdr_rows_seen": int(m.get("rows_in", 0)), "cdr_rows_kept": int(m.get("rows_kept", 0))}


def run_gold(spark: SparkSession, out: str) -> str:
    """Build the marts from published silver, write each once as Parquet
    (conformed to its declared schema) and once as CSV export, gate them and
    publish; returns the published folder."""
    source = current(spark, f"{out}/silver")
    customers = read_bucketed(spark, f"{source}/customers")
    by_customer = read_bucketed(spark, f"{source}/customer_activity") if hadoop_fs.exists(spark, f"{source}/customer_activity") else None
    cdrs = spark.read.parquet(f"{source}/cdrs")
    towers = spark.read.parquet(f"{source}/cell_towers")
    version = new_version()
    folder = f"{out}/gold/{version}"

    def write(name: str, df: DataFrame) -> DataFrame:
        defaults = CUSTOMER_SUMMARY_DEFAULTS if name == "fact_customer_summary" else None
        return write_mart(conform(df, MART_SCHEMAS[name], defaults),
                          f"{folder}/{name}", f"{folder}/csv/{name}")

    def summary_then_cohort() -> tuple[DataFrame, DataFrame]:
        s = write("fact_customer_summary", gold.fact_customer_summary(customers, cdrs, by_customer=by_customer))
        return s, write("fact_churn_cohort", gold.fact_churn_cohort(s))

    done = run_concurrently(spark, {
        "gold: customer summary + churn cohort": summary_then_cohort,
        "gold: fact_daily_network_metrics": lambda: write("fact_daily_network_metrics",
                                                          gold.fact_daily_network_metrics(cdrs)),
        "gold: fact_regional_performance": lambda: write("fact_regional_performance",
                                                         gold.fact_regional_performance(cdrs, towers)),
        "gold: dim_cell_towers": lambda: write("dim_cell_towers", towers),
    })
    summary, cohort = done.pop("gold: customer summary + churn cohort")
    written = {k.split(": ")[1]: v for k, v in done.items()}
    written["fact_customer_summary"] = summary
    written["fact_churn_cohort"] = cohort
    gate_marts(spark, written)
    publish(spark, f"{out}/gold", version)
    forget_bucketed(spark, f"{source}/customers", f"{source}/customer_activity")
    return folder


def gate_marts(spark: SparkSession, marts: dict[str, DataFrame]) -> dict[str, int]:
    """One aggregate per mart: its row count and the violations of its keys,
    NOT NULL columns and checks; raises when there are any."""
    results = run_concurrently(spark, {
        f"gate: {name}": (lambda n=name: load_check(marts[n], CONSTRAINTS[n])) for name in MART_SCHEMAS})
    enforce([v for _, vs in results.values() for v in vs])
    return {k.split(": ")[1]: n for k, (n, _) in results.items()}


def run_load(spark: SparkSession, folder: str, database: str) -> dict[str, int]:
    """Warehouse load: every mart is written anew beside the lake, gated there, and its declared table is then switched
    to the new files (``sinks.writers.load_table``); returns the rows read back from the tables."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    root = folder.rsplit("/gold/", 1)[0]

    def load(name: str) -> int:
        return load_table(spark, f"{database}.{name}", spark.read.parquet(f"{folder}/{name}"), MART_SCHEMAS[name],
                          CUSTOMER_SUMMARY_DEFAULTS if name == "fact_customer_summary" else None,
                          root=f"{root}/warehouse/{name}", check=CONSTRAINTS[name])

    done = run_concurrently(spark, {f"load: {name}": (lambda n=name: load(n)) for name in MART_SCHEMAS})
    return {k.split(": ")[1]: n for k, n in done.items()}


def run(spark: SparkSession, sf_dir: str, out: str, as_of: str = DEFAULT_AS_OF,
        run_ts: str = "2026-05-26T00:00:00Z", database: str = "towerlens") -> RunReport:
    """Run all stages. The sources are landed once as files; the bronze
    audit (an inventory, not a gate) scans them while silver cleans them;
    silver and gold publish only after their gates; gold reads published
    silver; load fills the declared tables of ``database``."""
    rep = RunReport()
    mark = materialized()

    def timed(name: str, fn: Callable[[], Any]) -> Callable[[], Any]:
        def go():
            t = time.time()
            result = fn()
            rep.timings[name] = time.time() - t
            return result
        return go

    source = Warehouse.from_sources(spark, sf_dir, as_of=as_of)
    paths = timed("land", lambda: run_land(spark, source, out))()
    w = Warehouse.from_landing(spark, paths, as_of=as_of)
    first = run_concurrently(spark, {
        "bronze": timed("bronze", lambda: run_bronze(spark, w, out, run_ts, paths)),
        "silver": timed("silver", lambda: run_silver(spark, w, out, run_ts)),
    })
    rep.counts.update(first["silver"])
    folder = timed("gold", lambda: run_gold(spark, out))()
    t = time.time()
    rep.counts.update(run_load(spark, folder, database))
    v1_regional_snapshot(spark, spark.table(f"{database}.fact_regional_performance")).collect()
    rep.timings["load"] = time.time() - t
    release_since(spark, mark)  # this run's tables in the checkpoint folder
    return rep
