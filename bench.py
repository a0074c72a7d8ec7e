"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` (default 8): one warm-up run, then ``$BENCH_RUNS``
timed runs (default 3); the per-query time is the median. Every run executes
the whole plan through the ``noop`` sink (nothing is collected to the
driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from phenolens.plans.queries import QUERIES  # noqa: E402
from phenolens.session import local_session  # noqa: E402

HEADLINE = [
    "phenotype_labels",
    "phenotype_label_counts",
    "cohort_case_branches",
    "lab_mean_by_label",
    "lab_mean_by_label_one_pass",
    "feature_tuples_all",
    "feature_tuples_filtered",
    "feature_index",
    "feature_matrix_long",
    "feature_moments",
    "feature_covariance",
    "streaming_kmeans_update",
    "streaming_kmeans_stream",
    "kmeans_clusters",
    "purity_report",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="phenolens-bench")
    times = {}
    for name in names:
        run_once(spark, name, sf_dir)  # warm-up: JIT, file listing, Python workers
        times[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
