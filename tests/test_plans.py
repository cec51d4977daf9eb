"""Plan shapes that matter at scale, checked on the executed physical plans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from towerlens.plans import analytics as A
from towerlens.plans import dq
from towerlens.plans import gold
from towerlens.plans.warehouse import Warehouse

from .conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cartesian_or_nested_loop_joins(spark, name):
    p = plan(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_hot_customer_aggregates_map_side(spark):
    """A customer holding a third of all CDRs: the per-customer aggregate
    runs partially before the shuffle."""
    w = Warehouse.from_sources(spark, SF_SMALL)
    hot = w.cdrs.withColumn("customer_id", F.when(F.rand(3) < 0.34, F.lit("HOT")).otherwise(F.col("customer_id")))
    p = plan(gold.customer_activity(hot))
    assert "partial_count" in p and p.index("partial_count") > p.index("Exchange")
    row = gold.customer_activity(hot).where("customer_id = 'HOT'").first()
    assert row.total_calls > 0


def test_tower_join_is_broadcast_after_size_check(spark):
    w = Warehouse.from_sources(spark, SF_SMALL)
    assert "BroadcastHashJoin" in plan(gold.cdr_tower_enrich(w.cdrs, w.towers))


def test_topk_rank_limits_before_shuffle(spark):
    w = Warehouse.from_sources(spark, SF_SMALL)
    p = plan(A.ex5_rank_in_cohort(w.customer_summary))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_pushdown_of_tuned_predicates(spark, scratch):
    w = Warehouse.from_sources(spark, SF_SMALL)
    w.customer_summary.write.parquet(f"{scratch}/s")
    s = spark.read.parquet(f"{scratch}/s")
    plain = plan(A.ex4_plain_predicate(s))
    upper = plan(A.ex4_upper_predicate(s))
    having = plan(A.ex1_having_form(s))
    assert "PushedFilters: [IsNotNull(contract), EqualTo(contract,Month-to-month)]" in plain
    assert "EqualTo(contract" not in upper
    assert "EqualTo(contract,Month-to-month)" in having


def test_no_size_check_gathers_rows(spark):
    """No join is preceded by a count of rows in one task, and no scan is dealt anew."""
    w = Warehouse.from_sources(spark, SF_SMALL)
    for df in (gold.cdr_tower_enrich(w.cdrs, w.towers), w.regional, dq.dq_orphan_cdrs(w.cdrs, w.customers)):
        p = plan(df)
        assert "GlobalLimit" not in p and "RoundRobinPartitioning" not in p and "Expand" not in p


def test_regional_aggregates_before_the_tower_join(spark):
    w = Warehouse.from_sources(spark, SF_SMALL)
    p = w.regional._jdf.queryExecution().optimizedPlan().toString()
    join = p.index("cell_tower_id")
    assert "Aggregate [cell_tower_id" in p and join >= 0
