"""Time the headline queries and print one JSON line.

$BENCH_SF_DIR names the test data (default sf0.1), $BENCH_CPUS the local cores. One warm-up per
query fills the JVM and the written tables; the recorded value is the median of three runs, each
writing the whole result to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from workload import registry
from workload.session import local_session

HEADLINES = [
    "intermediate_bids", "target_table", "feature_region_product_types", "feature_cost_qty_distance",
    "feature_competitors_previous_year", "feature_destination_price", "feature_region_price_movement",
    "feature_min_max_quantity", "feature_contract_timeframe", "feature_rollover",
    "feature_next_best_competitor", "feature_fill_rate", "feature_bid_flags", "feature_cluster",
    "feature_table", "bid_reference_table", "dashboard_price_by_category", "dashboard_reference_report",
    "value_at_risk", "total_churn_risk_bands", "top_products", "open_orders", "top_drivers", "scorecard",
    "backtest_predictions", "price_recommendation", "churn_contributions",
]


def run(spark, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    registry.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINES
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cpus)
    spent = {}
    for name in names:
        run(spark, sf_dir, name)
        spent[name] = round(statistics.median(run(spark, sf_dir, name) for _ in range(repeats)), 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum of median query times",
        "value": round(sum(spent.values()), 3),
        "unit": "sec",
        "queries": spent,
        "sf": float(scale.group(1)) if scale else None,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
