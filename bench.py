"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from flowsift.plans.catalog import QUERIES  # noqa: E402
from flowsift.session import local_session  # noqa: E402

HEADLINE = [
    "flow_label_binary", "flow_label_multiclass", "flow_coerce", "flow_dedupe", "flow_clean",
    "flow_clean_report", "class_distribution", "multiclass_index", "validate_records",
    "table_fingerprint", "csv_scan_clean", "stratified_sample", "topn_sample_per_class",
    "stratified_split", "stratified_folds", "class_weights", "standardize", "feature_statistics",
    "distribution_compare", "perturb_columns", "covariance_matrix", "metrics_binary",
    "classification_report", "metrics_multiclass", "threshold_sweep", "drift_impact",
    "model_compare_best", "score_batch", "score_summary", "permutation_importance",
    "linear_svm_scores", "logreg_scores", "rf_scores", "rff_svm_scores", "rbf_grid_search",
    "pca_projection",
    "stream_score", "stream_drift_windows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    # Start the session and its workers before timing.
    QUERIES["flow_coerce"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    QUERIES["class_distribution"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
