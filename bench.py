"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs once to warm up, then three timed runs; the reported time is
the median.  A run executes the whole plan into the ``noop`` sink (nothing is
collected to the driver).  Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.01 python bench.py [key ...]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lotmarket.plans import catalog  # noqa: E402
from lotmarket.session import local_session  # noqa: E402

HEADLINE = [
    "median_by_region", "kpi_overview", "hotspots", "risk_cv", "box_stats", "yoy_pivot",
    "neighborhood_returns", "fill_gaps", "poly_forecast", "factor_ranking", "corr_matrix",
    "dedup_key", "enrich_region", "target_encode", "fact_build", "clean_pipeline_a",
    "livability", "recommend_regions", "regression_metrics", "kfold_r2", "learning_curve",
    "bootstrap_interval", "parse_numeric_text", "bbox_join", "stream_tumbling",
]


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    keys = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app_name="lotmarket-bench")
    qs = catalog.queries()
    times = {}
    for k in keys:
        run_once(spark, qs[k], sf_dir)
        times[k] = round(statistics.median(run_once(spark, qs[k], sf_dir) for _ in range(3)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "sum_of_median_query_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
