"""Benchmark: run headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is fully executed with the no-op sink (every row computed, nothing
collected); the first query also pays JVM warm-up, so one warm-up query runs
before timing starts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyspark.plans.catalog import REGISTRY  # noqa: E402
from tallyspark.session import get_spark  # noqa: E402

HEADLINE = [
    # prepare: type, profile, impute, split
    "typed_projection", "null_profile", "mean_impute", "stratified_split", "second_split", "kfold",
    # evaluate with the fixed scorer
    "score_fixed", "metrics_by_split", "fold_metrics", "logloss",
    # dashboards
    "summary_stats", "class_distribution", "histogram_by_class", "box_stats", "box_by_class",
    "violin_density", "corr_matrix", "ols_trend",
    # validation, registry, search bookkeeping
    "negative_split", "request_validation", "batch_predict", "csv_typed_scan", "promote_best", "trial_draws", "best_trial", "leaderboard",
    "best_version", "gap_free_versions", "current_stage", "early_stop", "minmax_scale",
    # logging and streams
    "prediction_log_daily", "stream_score", "stream_monitor",
    # training and promotion
    "logit_importance", "logit_importance_l1", "rf_importance", "gbt_importance", "gbt_train_eval", "search_steps", "model_lifecycle", "all_versions_eval",
]
#: At full budget (50 trials) they take minutes: named on the command line only.
LONG = ["random_search", "cv_search"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    # JVM / code-generation warm-up on the smallest tables (not timed)
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in ("class_distribution", "metrics_by_split", "summary_stats", "early_stop"):
        REGISTRY[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
