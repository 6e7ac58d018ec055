"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is executed to completion with the ``noop`` sink (no collect to the driver); the time
includes fitting jobs the query runs.  One warm-up query runs first so JVM start-up is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "map_priority", "map_coverage", "onehot_event", "keep_cols", "pearson_pairs", "pearson_prune",
    "sigma3_value", "tukey_outer", "robust_price", "target_segment", "target_source_null",
    "split_rows", "downsample", "prepare_fit_on_train", "confusion", "auc", "threshold_sweep",
    "threshold_sweep_by_lang", "best_flags", "knn_classify", "knn_impute_uniform", "knn_impute_distance",
    "recipe_a", "recipe_b", "recipe_c",
]


def main() -> None:
    from featurekit.catalogue import QUERIES
    from featurekit.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, app="featurekit-bench")
    QUERIES["keep_cols"](spark, sf_dir).write.format("noop").mode("overwrite").save()   # warm-up
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
