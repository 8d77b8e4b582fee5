"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and executes the full plan with the ``noop`` sink (no
result is pulled to the driver). Prints ONE JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.
``BENCH_QUERIES`` (comma-separated) restricts the set.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "triage_report", "differential_top5", "scan_scorecard", "critical_alerts", "bulk_rule_scores",
    "recipe_diabetes", "recipe_cancer", "null_profile", "zero_profile", "quantile_iqr", "iqr_sequential_filter",
    "group_median_fill", "corr_matrix", "class_mean_cov", "hist30", "kde", "box_summary", "dedupe",
    "value_counts", "stratified_split", "stratified_kfold", "roc_auc", "avg_precision", "standard_scale",
    "one_hot", "rule_attribution", "sampled_shapley", "eda_cleaned", "enlarge", "bulk_score",
    "train_lr_fever", "train_compare_fever",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from riskloom.session import get_spark
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    from pyspark.sql import functions as F

    from riskloom.plans import train
    from riskloom.queries import registry
    from riskloom.sources.panels import load_panel

    reg = registry()

    def train_lr(spark, sf):
        res, _ = train.train_disease(load_panel(spark, sf, "fever"), "fever",
                                     models=["Logistic Regression (Balanced)"], max_train_rows=20000)
        return res

    def train_all(spark, sf):
        res, _ = train.train_disease(load_panel(spark, sf, "fever"), "fever", max_train_rows=20000)
        return res

    extra = {"train_lr_fever": train_lr, "train_compare_fever": train_all}
    names = only or HEADLINE
    # warm-up (JVM JIT, class loading, file listing): the flagship query on the smallest table set; not timed
    spark.read.parquet(f"{sf_dir}/region.parquet").agg(F.count(F.lit(1))).collect()
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        reg["triage_report"][0](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        fn = extra.get(name) or reg[name][0]
        t0 = time.time()
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
