"""Benchmark: the full pipeline (bronze audit -> silver -> gold -> load) on
the driver tables at $BENCH_SF_DIR, then every business query and dashboard
dataset over the published Parquet marts (each warmed up once). Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from towerlens.plans import analytics as A  # noqa: E402
from towerlens.plans import dashboards as D  # noqa: E402
from towerlens.plans import pipeline  # noqa: E402
from towerlens.plans.warehouse import Warehouse  # noqa: E402
from towerlens.session import build_session, checkpoint_dir  # noqa: E402


def host_calibration() -> float:
    """Seconds for a fixed pure-Python loop: a yardstick for the host's speed
    at the time of the run (not part of the measured value)."""
    t = time.time()
    acc = 0
    for i in range(5_000_000):
        acc += i
    return round(time.time() - t, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="run-bench-", dir="/tmp")
    t0 = time.time()
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.sql.warehouse.dir": f"{scratch}/spark-warehouse"})
    checkpoint_dir(spark, f"{scratch}/checkpoints")
    startup = time.time() - t0

    out = f"{scratch}/lake"
    times: dict[str, float] = {}
    t = time.time()
    rep = pipeline.run(spark, sf_dir, out)
    pipeline_sec = time.time() - t
    for k, v in rep.timings.items():
        times[f"stage_{k}"] = round(v, 3)

    w = Warehouse.from_path(spark, out)
    q_total = 0.0
    s, c, d, r = w.customer_summary, w.cohort, w.daily, w.regional
    suite = {
        "q01_executive_kpis": lambda: A.q01_executive_kpis(s),
        "q02_churn_by_contract": lambda: A.q02_churn_by_contract(s),
        "q03_high_risk_segments": lambda: A.q03_high_risk_segments(c),
        "q04_churn_by_internet": lambda: A.q04_churn_by_internet(s),
        "q05_revenue_at_risk": lambda: A.q05_revenue_at_risk(s),
        "q06_network_by_region": lambda: A.q06_network_by_region(r),
        "q07_daily_health_30": lambda: A.q07_daily_health_30(d),
        "q08_engagement_vs_churn": lambda: A.q08_engagement_vs_churn(s),
        "q09_payment_vs_churn": lambda: A.q09_payment_vs_churn(s),
        "q10_tenure_cohort_revenue": lambda: A.q10_tenure_cohort_revenue(s),
        "ex1_having_form": lambda: A.ex1_having_form(s),
        "ex1_where_form": lambda: A.ex1_where_form(s),
        "ex2_preaggregated_distinct": lambda: A.ex2_preaggregated_distinct(r),
        "ex3_topk_cohorts": lambda: A.ex3_topk_cohorts(c),
        "ex4_upper_predicate": lambda: A.ex4_upper_predicate(s),
        "ex4_plain_predicate": lambda: A.ex4_plain_predicate(s),
        "ex5_rank_in_cohort": lambda: A.ex5_rank_in_cohort(s),
        "ex6_cte_at_risk": lambda: A.ex6_cte_at_risk(spark, s),
        "v1_regional_snapshot": lambda: A.v1_regional_snapshot(spark, r),
        "d0_kpi_tiles": lambda: D.d0_kpi_tiles(s),
        "d1_contract_churn": lambda: D.d1_contract_churn(s),
        "d2_top_cohorts": lambda: D.d2_top_cohorts(c),
        "d3_regional_sorted": lambda: D.d3_regional_sorted(r),
        "d4_daily_success_trend": lambda: D.d4_daily_success_trend(d),
        "d5_engagement_bands_right": lambda: D.d5_engagement_bands_right(s),
    }
    for name, build in suite.items():
        build().write.format("noop").mode("overwrite").save()  # warm-up: compiled code and file listings
        t = time.time()
        build().write.format("noop").mode("overwrite").save()
        dt = time.time() - t
        q_total += dt
        times[name] = round(dt, 3)
    total = pipeline_sec + q_total
    print(json.dumps({
        "metric": "end_to_end_pipeline_plus_queries",
        "value": round(total, 3),
        "unit": "sec",
        "queries": times,
        "pipeline_sec": round(pipeline_sec, 3),
        "queries_sec": round(q_total, 3),
        "startup_sec": round(startup, 3),
        "host_calibration_sec": host_calibration(),
        "rows": rep.counts,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
