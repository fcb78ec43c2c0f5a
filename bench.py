"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from scorelake.operators import modeling as ml  # noqa: E402
from scorelake.plans import catalog, queries_model  # noqa: E402
from scorelake.session import build_session  # noqa: E402
from scorelake.sizing import kept  # noqa: E402

HEADLINE = [
    "prospect_features", "group_success_rate", "attach_group_stats", "elapsed_days", "feature_drift", "js_divergence", "drift_report",
    "missing_profile", "duplicate_rows", "iqr_outliers", "correlation_matrix", "leakage_report", "stratified_split", "stratified_kfold",
    "random_oversample", "roc_auc", "pr_curve", "threshold_grid", "classification_report", "keyword_sentiment", "extract_terms", "regex_flags",
    "check_constraints", "preprocess_batch", "explain_text", "select_k_best", "standard_scale", "segment_rollup", "daily_rollup", "fixed_window_limit",
]


def run(df) -> None:
    """Run the whole plan without keeping its rows."""
    df.write.format("noop").mode("overwrite").save()


def forest(spark, sf) -> None:
    """A forest of 96 trees of depth 5 on the joined orders, scored on every row."""
    data = kept(ml.vectorize(queries_model.tree_table(spark, sf), queries_model.TREE_FEATURES, "y"))
    model = ml.random_forest(96, 5).fit(data)
    run(ml.batch_score(data, model))
    data.unpersist()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.log.level": "ERROR"})
    known = catalog.queries()
    spark.read.parquet(f"{sf}/orders.parquet").agg(F.count(F.lit(1))).collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(known[name](spark, sf))
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    start = time.perf_counter()
    forest(spark, sf)
    times["forest_96_trees"] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
