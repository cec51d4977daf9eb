"""Structured Streaming form of the silver CDR layer and the daily network
mart: raw CDR CSV files land in a folder (the append-only raw zone), each
micro-batch runs the same operators as the batch pipeline.

Per micro-batch (``foreachBatch``):

1. ``clean_cdrs`` parses, filters, flags and keeps the first row per call_id
   by the declared order columns inside the batch;
2. call_ids already published in silver are removed, so a call id keeps its
   first-arrived row across batches and a replayed batch appends nothing
   twice;
3. batch and new rows are written as tables in the shared checkpoint folder
   and read back: step 2 must not be re-evaluated after the append below;
4. the new rows are appended to silver (sorted by call_date, customer_id);
5. the daily mart is rebuilt for every date of the cleaned batch, also of rows
   that were published before (a batch that is run again after a crash must
   rebuild its days although it appends nothing): the silver rows of those
   dates are re-aggregated and written, together with the other days of the
   snapshot before this epoch, as snapshot ``v<epoch>``. Readers take the
   newest complete snapshot (``latest_daily``); a replayed epoch overwrites
   its own snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from towerlens.plans.gold import fact_daily_network_metrics
from towerlens.plans.silver import clean_cdrs
from towerlens.schemas import CDRS_RAW
from towerlens.session import materialize, materialized, release_since
from towerlens.sources import hadoop_fs


def landing_stream(spark: SparkSession, landing_dir: str, schema: StructType = CDRS_RAW,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw CDR CSV files (header row) arriving in ``landing_dir``."""
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(landing_dir)


def _snapshots(spark: SparkSession, root: str) -> list[str]:
    """Complete snapshot folders (with a _SUCCESS marker), oldest first."""
    return [f"{root}/{n}" for n in hadoop_fs.list_dirs(spark, root)
            if n.startswith("v") and hadoop_fs.exists(spark, f"{root}/{n}/_SUCCESS")]


def latest_daily(spark: SparkSession, lake_dir: str, before_epoch: int | None = None) -> DataFrame | None:
    """The newest complete daily-mart snapshot (optionally older than an epoch)."""
    snaps = _snapshots(spark, f"{lake_dir}/gold/fact_daily_network_metrics")
    if before_epoch is not None:
        snaps = [s for s in snaps if int(s.rsplit("/v", 1)[1]) < before_epoch]
    return spark.read.parquet(snaps[-1]) if snaps else None


class CdrIngest:
    """The ``foreachBatch`` function (picklable state: paths and order)."""

    def __init__(self, lake_dir: str, order_cols: Sequence[str], keep_snapshots: int = 3):
        self.lake_dir = lake_dir.rstrip("/")
        self.order_cols = list(order_cols)
        self.keep_snapshots = max(2, keep_snapshots)  # a replayed epoch starts from the snapshot before it

    @property
    def silver(self) -> str:
        return f"{self.lake_dir}/silver/cdrs"

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        spark, mark = batch.sparkSession, materialized()
        batch_clean = materialize(clean_cdrs(batch, self.order_cols), f"cdr_batch_{epoch_id}")
        new = batch_clean
        if hadoop_fs.exists(spark, self.silver):
            published = spark.read.parquet(self.silver).select("call_id")
            new = materialize(batch_clean.join(published, "call_id", "left_anti"), f"cdr_new_{epoch_id}")
        (new.sortWithinPartitions("call_date", "customer_id")
         .write.mode("append").parquet(self.silver))
        self._refresh_daily(spark, batch_clean.select("call_date").distinct(), epoch_id)
        release_since(spark, mark)

    def _refresh_daily(self, spark: SparkSession, touched: DataFrame, epoch_id: int) -> None:
        silver = spark.read.parquet(self.silver)
        rebuilt = fact_daily_network_metrics(silver.join(touched, "call_date", "left_semi"))
        previous = latest_daily(spark, self.lake_dir, before_epoch=epoch_id)
        mart = rebuilt if previous is None else previous.join(touched, "call_date", "left_anti").unionByName(rebuilt)
        mart.write.mode("overwrite").parquet(
            f"{self.lake_dir}/gold/fact_daily_network_metrics/v{epoch_id:012d}")
        self._expire(spark)

    def _expire(self, spark: SparkSession) -> None:
        """Drop snapshots older than the newest ``keep_snapshots`` complete
        ones (readers always take the newest complete snapshot)."""
        old = _snapshots(spark, f"{self.lake_dir}/gold/fact_daily_network_metrics")[:-self.keep_snapshots]
        for path in old:
            hadoop_fs.delete(spark, path)


def start_cdr_ingest(spark: SparkSession, landing_dir: str, lake_dir: str, checkpoint_location: str,
                     order_cols: Sequence[str], schema: StructType = CDRS_RAW,
                     available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the ingestion query; ``available_now`` processes what has landed
    and stops (scheduled runs), otherwise it keeps polling."""
    stream = landing_stream(spark, landing_dir, schema, max_files_per_trigger)
    writer = (stream.writeStream.foreachBatch(CdrIngest(lake_dir, order_cols))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
