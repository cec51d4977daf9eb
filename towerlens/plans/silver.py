"""Silver layer: typed, cleaned, de-duplicated tables (M1-M3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from towerlens.constants import (
    BYTES_PER_MB,
    DAYS_PER_YEAR,
    MAX_CALL_SECONDS,
    TENURE_EDGES,
    TENURE_LABELS,
)
from towerlens.functions import (
    bucketize,
    eq_flag,
    lenient_number,
    lenient_timestamp,
    round_half_even,
)
from towerlens.operators import dedup_keep_first, outlier_filter


def normalise_names(df: DataFrame) -> DataFrame:
    """Column names: space and hyphen -> underscore, lower case (schema only)."""
    return df.toDF(*[c.replace(" ", "_").replace("-", "_").lower() for c in df.columns])


def impute_total_charges(df: DataFrame) -> DataFrame:
    """totalcharges: text -> number (bad -> NULL); tenure 0 -> 0.0; remaining
    NULLs take monthlycharges."""
    tc = lenient_number("totalcharges")
    tc = F.when(F.col("tenure") == 0, F.lit(0.0)).otherwise(tc)
    return df.withColumn("totalcharges", F.coalesce(tc, F.col("monthlycharges").cast("double")))


def clean_customers(raw: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    """M1: names, lenient totals, imputation, flags, keep-first dedup by ``order_cols`` (dropped), cohort."""
    df = normalise_names(raw).withColumnRenamed("customerid", "customer_id")
    df = impute_total_charges(df)
    df = df.withColumns({
        "churn_flag": eq_flag("churn", "Yes"),
        "is_senior_citizen": F.col("seniorcitizen").cast("int"),
    })
    df = dedup_keep_first(df, ["customer_id"], order_cols, drop_order_cols=True)
    return df.withColumn("tenure_cohort", bucketize("tenure", TENURE_EDGES, TENURE_LABELS))


def add_time_dims(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """call_date, call_hour, English weekday name."""
    t = F.col(ts)
    return df.withColumns({
        "call_date": F.to_date(t),
        "call_hour": F.hour(t),
        "day_of_week": F.date_format(t, "EEEE"),
    })


def clean_cdrs(raw: DataFrame, order_cols: Sequence[str],
               drop_order_cols: bool = True, observation: Observation | None = None) -> DataFrame:
    """M2: parse -> drop unparsable -> outlier filter -> keep-first dedup on
    call_id (filters run before the dedup) -> time dims -> flags -> MB.

    The columns that follow from others come after the dedup, which writes its rows once: they are computed when read."""
    df = raw.withColumn("timestamp", lenient_timestamp("timestamp")).dropna(subset=["timestamp"])
    df = outlier_filter(df, "duration_seconds", MAX_CALL_SECONDS, observation)
    df = dedup_keep_first(df, ["call_id"], order_cols, drop_order_cols=drop_order_cols)
    df = add_time_dims(df)
    return df.withColumns({
        "is_completed": eq_flag("call_status", "COMPLETED"),
        "is_dropped": eq_flag("call_status", "DROPPED"),
        "data_mb": round_half_even(F.col("bytes_transferred") / F.lit(float(BYTES_PER_MB)), 3),
    })


def clean_cell_towers(raw: DataFrame, as_of: str, order_cols: Sequence[str]) -> DataFrame:
    """M3 (= dim_cell_towers): date type, years in service as of a given day
    (whole days / 365.25, 2 decimals), keep-first dedup on cell_tower_id by ``order_cols`` (dropped)."""
    df = raw.withColumn("installation_date", F.to_date(F.col("installation_date")))
    days = F.datediff(F.lit(as_of).cast("date"), F.col("installation_date"))
    df = df.withColumn("years_in_service", round_half_even(days / F.lit(DAYS_PER_YEAR), 2))
    return dedup_keep_first(df, ["cell_tower_id"], order_cols, drop_order_cols=True)
