"""Bronze audit: inventory of the raw sources (IN1-IN6)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from towerlens.constants import SOURCES
from towerlens.operators import audit_record, null_counts
from towerlens.schemas import LANDED_SCHEMAS
from towerlens.session import run_concurrently
from towerlens.sources import read_csv
from towerlens.sources.adapters import CDR_ORDER, CUSTOMER_ORDER, TOWER_ORDER


def audit_sources(sources: dict[str, DataFrame], rescued: str | None = None) -> DataFrame:
    """One audit row per registered source (row/column counts, columns, NULL
    counts, with ``rescued`` also malformed fields), unioned by name."""
    rows = [audit_record(sources[name], name, desc, key, rescued) for name, desc, key in SOURCES
            if name in sources]
    return reduce(lambda a, b: a.unionByName(b), rows)


def audit_landed(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """The audit of landed CSV files: one scan of each source gives its rows, NULLs and malformed fields. The columns that
    stand for the file order are not part of a source."""
    order = {"telco_customer_churn.csv": CUSTOMER_ORDER, "cdr_records.csv": CDR_ORDER, "cell_towers.csv": TOWER_ORDER}
    return audit_sources({name: read_csv(spark, path, LANDED_SCHEMAS[name], rescued="_rescued").drop(*order[name])
                          for name, path in paths.items()}, "_rescued")


def audit_row_counts(sources: dict[str, DataFrame]) -> DataFrame:
    return audit_sources(sources).select("filename", "key_column", "row_count", "column_count")


def audit_null_counts(sources: dict[str, DataFrame]) -> DataFrame:
    """Long form (filename, column_name, null_count)."""
    parts = [null_counts(sources[name]).select(F.lit(name).alias("filename"), "*")
             for name, _, _ in SOURCES if name in sources]
    return reduce(lambda a, b: a.unionByName(b), parts)


def audit_total_rows(sources: dict[str, DataFrame]) -> DataFrame:
    return audit_row_counts(sources).agg(
        F.count(F.lit(1)).alias("total_sources"),
        F.sum("row_count").cast("bigint").alias("total_rows"))


def audit_document(spark: SparkSession, audit: DataFrame, run_ts: str,
                   file_stats: dict[str, DataFrame] | None = None) -> DataFrame:
    """The audit as one nested record: run id, stage, sources array; with
    ``file_stats`` (per source: file count, bytes, checksum) merged in.

    The audit has one row per registered source, so it is brought to the
    driver (bounded by the registry, not by the data) and rewrapped.
    """
    done = run_concurrently(spark, {"": audit.collect, **{k: v.first for k, v in (file_stats or {}).items()}})
    stats = {k: v.asDict() for k, v in done.items() if k}
    stat_fields = [StructField("file_count", LongType()), StructField("size_bytes", LongType()),
                   StructField("checksum_sha256_16", StringType())] if file_stats else []
    rows = []
    for r in done[""]:
        d = r.asDict(recursive=True)
        if file_stats:
            d |= stats.get(d["filename"], {})
        rows.append(d | {"ingested_at": run_ts})
    src_type = StructType(audit.schema.fields + stat_fields + [StructField("ingested_at", StringType())])
    schema = StructType([StructField("pipeline_run_id", StringType()), StructField("stage", StringType()),
                         StructField("sources", ArrayType(src_type))])
    run_id = run_ts.replace("-", "").replace(":", "").replace("T", "_").rstrip("Z")[:15]
    return spark.createDataFrame([(run_id, "bronze", rows)], schema)
