"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the data and
the cores. Building the cleaned-legs table is timed on its own as ``stage_clean_legs``; the
queries after it read that table. Results go to the noop sink, so every row is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from legwork.registry import load  # noqa: E402
from legwork.registry.base import legs  # noqa: E402
from legwork.session import apply_defaults, local_session  # noqa: E402

HEADLINE = [
    "scope_filter", "local_to_utc", "hist_delay_origin", "hist_flight_median", "lag_delay_global",
    "prev_leg_known_delay", "legs_per_day", "day_so_far_dep", "day_so_far_arr", "range_join_same_day",
    "holiday_nearest", "weather_join", "null_profile", "numeric_profile", "describe", "corr_matrix",
    "duplicate_counts", "hist50", "density_points", "chrono_split", "stratified_split", "minmax_scale",
    "one_hot", "headline_metrics", "roc_auc_ovr", "degree", "components", "clustering_coeff",
    "weekly_edges", "daily_counts", "feature_table", "raw_to_features", "pagerank_fixed", "core_number", "knn_vote", "bayes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = apply_defaults(local_session("legwork-bench", cpus))
    entries = load()
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors
    timings = {}

    def timed(name, job):
        started = time.perf_counter()
        job()
        timings[name] = round(time.perf_counter() - started, 3)

    timed("stage_clean_legs", lambda: legs(spark, sf_dir))
    for name in HEADLINE:
        timed(name, lambda: entries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
