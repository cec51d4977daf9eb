"""Adapters: the driver's TPC-H-like tables -> the three raw source tables.

The reference's own inputs (a customer CSV, a CDR CSV, a tower CSV) are not
shipped, so each raw table is derived deterministically from driver tables
with plain column arithmetic. The derivation plants the cases the pipeline has
to handle: blank and unparsable totals, bin-edge tenures, unparsable
timestamps, over-long calls, duplicate call ids, customers and towers, NULLs,
CDRs of unknown towers and customers, and customers without activity. Every
row of the driver tables is kept: cases are planted by rewriting or repeating
rows.

Money is built as integer cents -> decimal -> double, never by casting a
double to an integer type (engines differ on that cast).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.sources.tables import read_table


def _case(expr: Column, mapping: list[tuple[object, str]], default: str) -> Column:
    out = None
    for key, val in mapping:
        cond = expr == F.lit(key)
        out = F.when(cond, F.lit(val)) if out is None else out.when(cond, F.lit(val))
    return out.otherwise(F.lit(default))


def _yes_no(cond: Column) -> Column:
    return F.when(cond, F.lit("Yes")).otherwise(F.lit("No"))


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> customers_raw (21 columns, key customerID, and ``file_row``, the declared order).

    Some customers come a second time, later in the file, with values that sort before the first row's.
    """
    k = F.col("c_custkey")
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment",
        F.explode(F.when(k % 60 == 8, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    again = F.col("copy") == 1
    tenure = F.when(again, F.lit(0)).otherwise(k * 7 % 76).cast("int")
    monthly_dec = (F.floor(F.col("c_acctbal") + F.lit(1000)).cast("bigint").cast("decimal(10,0)")
                   * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(8,2)")
    seg = F.col("c_mktsegment")
    contract = (F.when(seg.isin("BUILDING", "MACHINERY"), F.lit("Month-to-month"))
                .when(seg == "AUTOMOBILE", F.lit("One year")).otherwise(F.lit("Two year")))
    churn_cut = (F.when(seg.isin("BUILDING", "MACHINERY"), F.lit(43))
                 .when(seg == "AUTOMOBILE", F.lit(11)).otherwise(F.lit(3)))
    internet = _case(F.col("c_nationkey") % 3, [(0, "DSL"), (1, "Fiber optic")], "No")
    phone = F.when(k % 10 == 4, F.lit("No")).otherwise(F.lit("Yes"))
    total = (F.when(tenure == 0, F.lit(" "))
             .when(k % 50 == 7, F.lit("n/a"))
             .otherwise((monthly_dec * tenure).cast("decimal(12,2)").cast("string")))

    def service(mod: int) -> Column:
        return (F.when(internet == "No", F.lit("No internet service"))
                .otherwise(_yes_no(k % mod == 1)))

    return c.select(
        k.cast("string").alias("customerID"),
        F.when((k % 2 == 0) & ~again, F.lit("Female")).when(again, F.lit("Agender")).otherwise(F.lit("Male")).alias("gender"),
        (k % 6 == 0).cast("int").alias("SeniorCitizen"),
        _yes_no(k % 3 == 0).alias("Partner"),
        F.when(k % 45 != 11, _yes_no(k % 5 == 0)).alias("Dependents"),
        tenure.alias("tenure"),
        phone.alias("PhoneService"),
        F.when(phone == "No", F.lit("No phone service")).otherwise(_yes_no(k % 4 == 1)).alias("MultipleLines"),
        internet.alias("InternetService"),
        service(3).alias("OnlineSecurity"),
        service(4).alias("OnlineBackup"),
        service(5).alias("DeviceProtection"),
        service(7).alias("TechSupport"),
        service(2).alias("StreamingTV"),
        service(9).alias("StreamingMovies"),
        contract.alias("Contract"),
        _yes_no(k % 8 < 5).alias("PaperlessBilling"),
        _case(F.col("c_nationkey") % 4,
              [(0, "Electronic check"), (1, "Mailed check"), (2, "Bank transfer (automatic)")],
              "Credit card (automatic)").alias("PaymentMethod"),
        monthly_dec.cast("double").alias("MonthlyCharges"),
        total.alias("TotalCharges"),
        F.when(k * 31 % 100 < churn_cut, F.lit("Yes")).otherwise(F.lit("No")).alias("Churn"),
        (k * 2 + F.col("copy")).cast("bigint").alias("file_row"),
    )


CUSTOMER_ORDER = ["file_row"]


def cdrs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders -> cdrs_raw (9 columns + declared order ord0..ord4).

    ``ord0..ord4`` stand in for the file order of a CSV: keep-first dedup on
    call_id orders by them.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_shipdate")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    part = F.col("l_partkey")
    line = F.col("l_linenumber")
    flag = F.col("l_returnflag")
    ts_text = F.concat(
        F.substring(F.col("l_shipdate").cast("string"), 1, 10), F.lit("T"),
        F.when(line < 4, F.lit("0")).otherwise(F.lit("1")), line.cast("string"), F.lit(":30:00"))
    return j.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), line.cast("string")).alias("call_id"),
        # customers without activity: their calls count for the next customer
        F.concat(F.when((F.col("l_orderkey") % 4000 == 1) & (line == 1), F.lit("U")).otherwise(F.lit("")),  # unknown
                 F.when(F.col("o_custkey") % 40 == 3, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
                 .cast("string")).alias("customer_id"),
        F.when(part % 250 == 3, F.lit("bad-ts")).otherwise(ts_text).alias("timestamp"),
        _case(flag, [("A", "VOICE"), ("N", "DATA")], "SMS").alias("call_type"),
        F.when(part % 500 == 0, F.lit(90000))
         .otherwise(F.col("l_quantity").cast("int") * 60).alias("duration_seconds"),
        F.when(flag == "N", F.floor(F.col("l_extendedprice") * 1000).cast("bigint"))
         .otherwise(F.lit(0).cast("bigint")).alias("bytes_transferred"),
        # unknown towers: these supplier keys become keys that no tower has
        F.concat(F.when(F.col("l_suppkey") % 10 == 9, F.lit("X")).otherwise(F.lit("")),
                 F.col("l_suppkey").cast("string")).alias("cell_tower_id"),
        F.when(part % 70 == 9, F.lit(None).cast("string")).when(part % 20 == 1, F.lit("DROPPED"))
         .when(part % 33 == 2, F.lit("FAILED")).otherwise(F.lit("COMPLETED")).alias("call_status"),
        (F.floor(F.col("l_extendedprice")).cast("bigint").cast("decimal(10,0)")
         * F.lit("0.0001").cast("decimal(5,4)")).cast("double").alias("cost_usd"),
        F.col("l_shipdate").alias("ord0"), part.alias("ord1"), F.col("l_suppkey").alias("ord2"),
        F.col("l_quantity").alias("ord3"), F.col("l_extendedprice").alias("ord4"),
    )


CDR_ORDER = ["ord0", "ord1", "ord2", "ord3", "ord4"]


def towers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier x nation x region -> towers_raw (8 columns, key cell_tower_id, and ``file_row``, the declared order).

    Some towers come a second time, later in the file, with values that sort before the first row's.
    """
    s = read_table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_nationkey",
        F.explode(F.when(F.col("s_suppkey") % 7 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (s.join(n, s.s_nationkey == n.n_nationkey, "inner")
         .join(r, F.col("n_regionkey") == r.r_regionkey, "inner"))
    k = F.col("s_suppkey")
    return j.select(
        k.cast("string").alias("cell_tower_id"),
        F.when(F.col("copy") == 1, F.lit("A")).otherwise(F.col("r_name")).alias("region"),
        F.col("n_name").alias("city"),
        (F.lit(8.0) + (k * 13 % 2700) / F.lit(100.0)).alias("latitude"),
        (F.lit(68.0) + (k * 17 % 2900) / F.lit(100.0)).alias("longitude"),
        F.when((k % 5).isin(1, 3), F.lit("5G")).otherwise(F.lit("4G")).alias("technology"),
        F.date_add(F.lit("2020-01-01").cast("date"), (k * 37 % 1461).cast("int")).alias("installation_date"),
        F.when(k % 12 != 5, _case(k % 4, [(0, 500), (1, 1000), (2, 2000)], 5000).cast("int")).alias("capacity_users"),
        (k * 2 + F.col("copy")).cast("bigint").alias("file_row"),
    )


TOWER_ORDER = ["file_row"]


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three raw tables under their source file names."""
    return {
        "telco_customer_churn.csv": customers_raw(spark, sf_dir),
        "cdr_records.csv": cdrs_raw(spark, sf_dir),
        "cell_towers.csv": towers_raw(spark, sf_dir),
    }
