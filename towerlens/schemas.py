"""Declared schemas of the raw sources and the warehouse marts, and the
warehouse constraints (primary keys, NOT NULL, CHECK)."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from towerlens.constants import ALLOWED_TECHNOLOGIES
from towerlens.operators.constraints import TableConstraints


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, I, L, D, DT, TS = StringType(), IntegerType(), LongType(), DoubleType(), DateType(), TimestampNTZType()

CUSTOMERS_RAW = _s(
    ("customerID", S), ("gender", S), ("SeniorCitizen", I), ("Partner", S), ("Dependents", S),
    ("tenure", I), ("PhoneService", S), ("MultipleLines", S), ("InternetService", S),
    ("OnlineSecurity", S), ("OnlineBackup", S), ("DeviceProtection", S), ("TechSupport", S),
    ("StreamingTV", S), ("StreamingMovies", S), ("Contract", S), ("PaperlessBilling", S),
    ("PaymentMethod", S), ("MonthlyCharges", D), ("TotalCharges", S), ("Churn", S))

CDRS_RAW = _s(
    ("call_id", S), ("customer_id", S), ("timestamp", S), ("call_type", S), ("duration_seconds", I),
    ("bytes_transferred", L), ("cell_tower_id", S), ("call_status", S), ("cost_usd", D))

# The landed CDR file carries its row order as columns (keep-first dedup).
CDRS_RAW_ORDERED = _s(*[(f.name, f.dataType) for f in CDRS_RAW.fields],
                      ("ord0", TS), ("ord1", L), ("ord2", L), ("ord3", D), ("ord4", D))

TOWERS_RAW = _s(
    ("cell_tower_id", S), ("region", S), ("city", S), ("latitude", D), ("longitude", D),
    ("technology", S), ("installation_date", DT), ("capacity_users", I))

# The landed customer and tower files carry their row order too.
CUSTOMERS_RAW_ORDERED = _s(*[(f.name, f.dataType) for f in CUSTOMERS_RAW.fields], ("file_row", L))
TOWERS_RAW_ORDERED = _s(*[(f.name, f.dataType) for f in TOWERS_RAW.fields], ("file_row", L))

LANDED_SCHEMAS = {"telco_customer_churn.csv": CUSTOMERS_RAW_ORDERED, "cdr_records.csv": CDRS_RAW_ORDERED,
                  "cell_towers.csv": TOWERS_RAW_ORDERED}

DIM_CELL_TOWERS = _s(*[(f.name, f.dataType) for f in TOWERS_RAW.fields], ("years_in_service", D))

FACT_DAILY_NETWORK_METRICS = _s(
    ("call_date", DT), ("total_calls", L), ("completed_calls", L), ("dropped_calls", L),
    ("unique_customers_active", L), ("total_data_mb", D), ("avg_duration_sec", D),
    ("total_revenue_usd", D), ("drop_rate_pct", D), ("call_success_rate_pct", D))

FACT_REGIONAL_PERFORMANCE = _s(
    ("region", S), ("total_calls", L), ("completed_calls", L), ("dropped_calls", L),
    ("unique_customers", L), ("total_data_mb", D), ("total_revenue_usd", D), ("active_towers", L),
    ("drop_rate_pct", D), ("revenue_per_customer_usd", D))

FACT_CHURN_COHORT = _s(
    ("tenure_cohort", S), ("contract", S), ("paymentmethod", S), ("customer_count", L),
    ("churn_count", L), ("avg_monthly_charges", D), ("avg_total_charges", D), ("avg_clv", D),
    ("churn_rate_pct", D))

FACT_CUSTOMER_SUMMARY = _s(
    ("customer_id", S), ("gender", S), ("seniorcitizen", I), ("partner", S), ("dependents", S),
    ("tenure", I), ("phoneservice", S), ("multiplelines", S), ("internetservice", S),
    ("onlinesecurity", S), ("onlinebackup", S), ("deviceprotection", S), ("techsupport", S),
    ("streamingtv", S), ("streamingmovies", S), ("contract", S), ("paperlessbilling", S),
    ("paymentmethod", S), ("monthlycharges", D), ("totalcharges", D), ("churn", S),
    ("churn_flag", I), ("is_senior_citizen", I), ("tenure_cohort", S), ("total_calls", L),
    ("total_voice_minutes", D), ("total_data_mb", D), ("total_sms", L), ("dropped_calls", L),
    ("avg_call_duration_sec", D), ("last_activity_date", TS), ("engagement_score", D),
    ("estimated_clv_usd", D))

MART_SCHEMAS = {
    "dim_cell_towers": DIM_CELL_TOWERS,
    "fact_customer_summary": FACT_CUSTOMER_SUMMARY,
    "fact_daily_network_metrics": FACT_DAILY_NETWORK_METRICS,
    "fact_regional_performance": FACT_REGIONAL_PERFORMANCE,
    "fact_churn_cohort": FACT_CHURN_COHORT,
}

# Activity columns that default to 0 when a load leaves them out.
CUSTOMER_SUMMARY_DEFAULTS = {
    "total_calls": 0, "total_voice_minutes": 0.0, "total_data_mb": 0.0,
    "total_sms": 0, "dropped_calls": 0, "avg_call_duration_sec": 0.0,
}

CONSTRAINTS = {
    "customers": TableConstraints("customers", primary_key=("customer_id",),
                                  min_values={"monthlycharges": 0}),
    "dim_cell_towers": TableConstraints(
        "dim_cell_towers", primary_key=("cell_tower_id",), not_null=("region",),
        allowed_values={"technology": tuple(ALLOWED_TECHNOLOGIES)}),
    "fact_customer_summary": TableConstraints(
        "fact_customer_summary", primary_key=("customer_id",), not_null=("churn_flag",)),
    "fact_daily_network_metrics": TableConstraints(
        "fact_daily_network_metrics", primary_key=("call_date",),
        not_null=("total_calls", "completed_calls", "dropped_calls", "unique_customers_active")),
    "fact_regional_performance": TableConstraints(
        "fact_regional_performance", primary_key=("region",)),
    "fact_churn_cohort": TableConstraints(
        "fact_churn_cohort", primary_key=("tenure_cohort", "contract", "paymentmethod")),
}
