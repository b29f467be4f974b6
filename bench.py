"""Time headline queries and print one JSON line: ``BENCH_SF_DIR``, ``BENCH_CPUS`` set the tables and cores.

Query names given as arguments replace the headline set; ``all`` stands for every query.
"""

from __future__ import annotations

import json
import os
import sys
import time

from stockwise import plans
from stockwise.session import local_session

HEADLINE = [
    "lag_features_daily", "baseline_accuracy", "accuracy_metrics", "multi_grain_rollup", "range_join_cumsum",
    "unit_price", "cost_share", "accuracy_windows", "monthly_bands", "mix_forecast", "trend_season_forecast",
    "stock_rollforward", "shortage_allocation", "reorder_plan", "calloff_plan", "plan_base", "availability_mart",
    "recursive_forecast", "holt_winters_grid", "row_count_ratio",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    jobs = plans.all_queries()
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(jobs)
    # One small query first, so that the start of the engine is not charged to the first one measured.
    jobs["agg_having"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        jobs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
