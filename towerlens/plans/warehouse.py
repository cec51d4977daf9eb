"""Wiring: raw sources -> silver -> gold, built lazily per mart.

``Warehouse.from_sources`` derives everything from the driver tables;
``Warehouse.from_path`` reads marts written by the pipeline. Properties are
built on first use, so a query only plans the marts it needs.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from towerlens.constants import DEFAULT_AS_OF
from towerlens.plans import gold, silver
from towerlens.sources import adapters


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str | None = None, as_of: str = DEFAULT_AS_OF,
                 rank_parts: int | None = None, tables: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        self.rank_parts = rank_parts
        self._tables = dict(tables or {})

    @classmethod
    def from_sources(cls, spark: SparkSession, sf_dir: str, **kw) -> Warehouse:
        return cls(spark, sf_dir, **kw)

    @classmethod
    def from_landing(cls, spark: SparkSession, paths: dict[str, str], as_of: str = DEFAULT_AS_OF) -> Warehouse:
        """Raw sources read from landed CSV files with their declared schemas."""
        from towerlens.schemas import CDRS_RAW_ORDERED, CUSTOMERS_RAW_ORDERED, TOWERS_RAW_ORDERED
        from towerlens.sources import read_csv
        w = cls(spark, None, as_of=as_of)
        w.customers_raw = read_csv(spark, paths["telco_customer_churn.csv"], CUSTOMERS_RAW_ORDERED)
        w.cdrs_raw = read_csv(spark, paths["cdr_records.csv"], CDRS_RAW_ORDERED)
        w.towers_raw = read_csv(spark, paths["cell_towers.csv"], TOWERS_RAW_ORDERED)
        return w

    @classmethod
    def from_path(cls, spark: SparkSession, root: str) -> Warehouse:
        """Silver and gold tables written by ``pipeline.run``."""
        silver_names = ["customers", "cdrs", "cell_towers"]
        gold_names = ["fact_customer_summary", "fact_daily_network_metrics",
                      "fact_regional_performance", "fact_churn_cohort"]
        from towerlens.sinks.publish import current
        silver_folder, gold_folder = current(spark, f"{root}/silver"), current(spark, f"{root}/gold")
        tables = {n: spark.read.parquet(f"{silver_folder}/{n}") for n in silver_names}
        tables.update({n: spark.read.parquet(f"{gold_folder}/{n}") for n in gold_names})
        return cls(spark, None, tables=tables)

    def serve(self, names: list[str] | None = None) -> dict[str, int]:
        """Keep the query-facing marts in executor memory (spilling to disk)
        for a burst of queries, like a warehouse load; returns row counts.
        Lost blocks are recomputed from the Parquet files."""
        from pyspark import StorageLevel
        counts = {}
        for n in names or ["fact_customer_summary", "fact_daily_network_metrics",
                           "fact_regional_performance", "fact_churn_cohort"]:
            self._tables[n] = self._tables[n].persist(StorageLevel.MEMORY_AND_DISK)
            counts[n] = self._tables[n].count()
        return counts

    def _get(self, name: str, build):
        if name not in self._tables:
            self._tables[name] = build()
        return self._tables[name]

    # raw ---------------------------------------------------------------
    @cached_property
    def customers_raw(self) -> DataFrame:
        return adapters.customers_raw(self.spark, self.sf_dir)

    @cached_property
    def cdrs_raw(self) -> DataFrame:
        return adapters.cdrs_raw(self.spark, self.sf_dir)

    @cached_property
    def towers_raw(self) -> DataFrame:
        return adapters.towers_raw(self.spark, self.sf_dir)

    def raw_sources(self) -> dict[str, DataFrame]:
        return {"telco_customer_churn.csv": self.customers_raw.drop(*adapters.CUSTOMER_ORDER),
                "cdr_records.csv": self.cdrs_raw.drop(*adapters.CDR_ORDER),
                "cell_towers.csv": self.towers_raw.drop(*adapters.TOWER_ORDER)}

    # silver ------------------------------------------------------------
    @property
    def customers(self) -> DataFrame:
        return self._get("customers", lambda: silver.clean_customers(self.customers_raw, adapters.CUSTOMER_ORDER))

    @property
    def cdrs(self) -> DataFrame:
        return self._get("cdrs", lambda: silver.clean_cdrs(self.cdrs_raw, adapters.CDR_ORDER))

    @property
    def towers(self) -> DataFrame:
        return self._get("cell_towers", lambda: silver.clean_cell_towers(self.towers_raw, self.as_of, adapters.TOWER_ORDER))

    # gold --------------------------------------------------------------
    @property
    def dim_cell_towers(self) -> DataFrame:
        return self.towers

    @property
    def customer_summary(self) -> DataFrame:
        return self._get("fact_customer_summary", lambda: gold.fact_customer_summary(
            self.customers, self.cdrs, self.rank_parts))

    @property
    def daily(self) -> DataFrame:
        return self._get("fact_daily_network_metrics", lambda: gold.fact_daily_network_metrics(self.cdrs))

    @property
    def regional(self) -> DataFrame:
        return self._get("fact_regional_performance",
                         lambda: gold.fact_regional_performance(self.cdrs, self.towers))

    @property
    def cohort(self) -> DataFrame:
        return self._get("fact_churn_cohort", lambda: gold.fact_churn_cohort(self.customer_summary))
