"""Time the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (table folder), ``BENCH_CPUS``, ``BENCH_KEYS`` (comma-separated
names, or ``all``). Every result is computed in full and sent to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tallyframe.catalog import QUERIES
from tallyframe.session import PLAN_SETTINGS, RESULT_SETTINGS

HEADLINE = """
impute_median clean_table coerce_numeric split_train_test
prof_missing prof_describe prof_skewness prof_corr_matrix prof_categorical prof_boxplot prof_full
ratio_features scale_standard encode_onehot encode_label engineer_features
val_strict_cross val_business_cross val_batch val_rule_counts
log_stats log_hourly log_page log_search metric_stats perf_last_n outlier_ratio
counter_requests hist_time hist_quantile gauges batch_stats rate_windows avg_over_time
join_eval_spine alert_high_error_rate alert_slow_processing
eval_regression eval_summary eval_residual_hist latest_version_by_stage model_info
log_append_requests split_store train_linear train_tree score_batch
stream_counters stream_hourly stream_rates
""".split()


def session(cpus: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    local = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**PLAN_SETTINGS, **RESULT_SETTINGS, **local}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = os.environ.get("BENCH_KEYS", "")
    names = list(QUERIES) if keys == "all" else keys.split(",") if keys else HEADLINE
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["log_stats"](spark, folder).write.format("noop").mode("overwrite").save()  # start the JVM parts
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    spark.stop()
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}
        )
    )


if __name__ == "__main__":
    main()
