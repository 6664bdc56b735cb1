"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_PATTERN  1 also times the usual job-per-result way of getting the same results
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from statloom.session import build_session  # noqa: E402

HEADLINE = ["wide_prepare", "pair_covariance", "pair_correlation", "correlation_report_large", "wide_covariance",
            "ols_lines", "ols_t_tests", "partial_f", "leverage", "best_subset_lines", "best_subset_sweep", "ols_illconditioned", "pca_embeddings", "cv_grid",
            "predict_evaluate", "evaluate_by_slice", "linear_metrics", "least_squares_metrics", "tree_metrics",
            "forest_metrics", "gbt_metrics", "forest_importance", "kmeans_profile", "kmeans_assign", "kmeans_cost", "kmeans_elbow", "gmm_components",
            "keyed_upsert", "keyed_stored", "csv_external_roundtrip", "parquet_roundtrip"]
SLOW = {"gbt_metrics", "kmeans_assign", "kmeans_cost", "gmm_components", "kmeans_profile", "forest_metrics", "forest_importance"}


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__ui__enabled="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    from statloom.catalogue import ALL

    def run(name: str):
        return lambda: ALL[name][0](spark, folder).write.format("noop").mode("overwrite").save()

    for name in ("correlation_report_large", "wide_prepare"):  # start the JVM code paths and the Python workers
        run(name)()
    times = {}
    for name in HEADLINE:
        first = seconds(run(name))
        times[name] = round(first if name in SLOW else min(first, seconds(run(name))), 3)
    result = {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
              "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}
    if os.environ.get("BENCH_PATTERN") == "1":
        from tools.job_pattern import compare
        result["pattern"] = compare(spark, folder)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
