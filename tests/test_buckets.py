"""Tables bucketed by a unique key: no exchange for key checks, joins and match rates on it."""

import pytest
from pyspark.sql import functions as F

from towerlens.operators import constraint_violations
from towerlens.plans import dq, gold
from towerlens.plans.warehouse import Warehouse
from towerlens.schemas import CONSTRAINTS
from towerlens.sinks.buckets import forget_bucketed, read_bucketed, write_bucketed

from .conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def tables(spark, scratch):
    """Bucketed customers and activity of sf0.001 with a third of the CDRs on one customer, and the plain frames."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    w = Warehouse.from_sources(spark, SF_SMALL)
    hot = w.customers.agg(F.min("customer_id")).first()[0]
    cdrs = w.cdrs.withColumn("customer_id", F.when(F.crc32(F.col("call_id").cast("string")) % 3 == 0, F.lit(hot))
                             .when(F.crc32(F.col("call_id").cast("string")) % 17 == 1, F.lit(None)).otherwise(F.col("customer_id")))
    customers = write_bucketed(w.customers, f"{scratch}/customers", "customer_id", 5)
    activity = write_bucketed(gold.cdrs_by_customer(cdrs), f"{scratch}/activity", "customer_id", 5)
    yield w, cdrs, customers, activity, scratch
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_exchange_on_the_bucketed_key(spark, tables):
    w, cdrs, customers, activity, _ = tables
    for df in (gold.join_activity(customers, activity),                                    # JN1
               gold.customer_match(activity, customers),                                   # JN3
               constraint_violations(customers, CONSTRAINTS["customers"])):                # DQ7, DQ9
        p = plan(df)
        assert "hashpartitioning" not in p and "BroadcastExchange" not in p, p
    assert "hashpartitioning" in plan(gold.customer_summary_base(w.customers, cdrs))  # the plain frames need it


def test_bucketed_results_equal_the_plain_ones(spark, tables):
    w, cdrs, customers, activity, _ = tables
    plain = gold.customer_summary_base(w.customers, cdrs)
    joined = gold.join_activity(customers, activity).select(*plain.columns)
    assert joined.exceptAll(plain).count() == 0 and plain.exceptAll(joined).count() == 0
    rate = dq.dq_referential_integrity(cdrs, w.customers, w.towers)
    assert gold.customer_match(activity, customers).first()["customer_id_match_pct"] == pytest.approx(rate.first()[0], abs=0.006)
    assert dq.dq_report(spark, customers, cdrs, w.towers, "now", by_customer=activity).collect() \
        == dq.dq_report(spark, w.customers, cdrs, w.towers, "now").collect()


def test_buckets_are_even_and_read_by_path(spark, tables):
    w, cdrs, customers, activity, scratch = tables
    sizes = [r["count"] for r in activity.groupBy(F.expr("pmod(hash(customer_id), 5)")).count().collect()]
    assert max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]
    forget_bucketed(spark, f"{scratch}/customers")
    again = read_bucketed(spark, f"{scratch}/customers")
    assert again.schema == customers.schema and again.count() == w.customers.count()
    assert spark.read.parquet(f"{scratch}/customers").exceptAll(w.customers).count() == 0
    with pytest.raises(FileExistsError):
        write_bucketed(w.customers, f"{scratch}/customers", "customer_id", 5)


def test_plain_and_empty_tables(spark, scratch):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    df.write.parquet(f"{scratch}/plain")
    assert read_bucketed(spark, f"{scratch}/plain").count() == 2
    assert write_bucketed(df.where("v > 9"), f"{scratch}/empty", "k", 3).count() == 0
    assert sorted(r.v for r in write_bucketed(df, f"{scratch}/null", "k", 3).collect()) == [1, 2]
