"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

Every query is forced with a ``noop`` write (full execution, nothing collected).
Stages share one pipeline, so each timing is the marginal cost of that stage:
``panel`` is the adapter from the raw parquet tables (lineitem join +
aggregates + reliable checkpoint); later queries read the stage checkpoints.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "feat_fill", "leakage_check", "baseline_seasonal_naive", "metrics_all", "elasticity_shrink",
    "elasticity_lookup", "simulate_candidates", "optimize_prices", "sku_region_metrics", "replenishment",
    "transfer_allocation", "joint_recommendations", "bt_compare", "rollback_summary", "kpi_headline",
    "stockout_heatmap", "review_queue", "top_opportunities", "scenario_run", "demand_ridge",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from shelfwise.session import get_spark
    spark = get_spark(master=f"local[{cpus}]", app="shelfwise-bench", shuffle_partitions=int(cpus))
    from shelfwise.plans import registry as reg

    def force(df):
        df.write.format("noop").mode("overwrite").save()

    # JVM warm-up (class loading, JIT) outside the timed region
    spark.range(100_000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    t0 = time.time()
    p = reg.pipe(spark, sf_dir)
    force(p.panel)
    times["panel"] = round(time.time() - t0, 3)
    for name in HEADLINE:
        t = time.time()
        force(reg.QUERIES[name](spark, sf_dir))
        times[name] = round(time.time() - t, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_wall_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
