"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) names the tables, ``BENCH_CPUS`` the
number of local threads. Every result is computed in full into the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from foldcast.plans.queries import QUERIES  # noqa: E402

HEADLINE = [
    "weekly_panel", "part_panel", "enrich_weather", "history_buckets", "missing_values",
    "feature_info", "filled_panel", "seasonal_decompose", "seasonal_decompose_zero_replaced",
    "lowess_robust", "split_train_test", "split_counts", "scaffold_actuals", "seasonal_naive",
    "dashboard_rows", "seasonal_naive_wmape", "eval_rows", "global_wmape", "metric_suite",
    "drift_forecast", "trend_season_forecast", "model_leaderboard", "holiday_effects",
    "arima_closed_form", "arima_coefficients", "explain_forecast", "xreg_one_covariate",
    "xreg_multi", "arima_auto", "arima_auto_models", "lowess_by_series", "evaluated_items",
    "pooled_dashboard_rows", "dashboard_append", "window_examples", "global_gbt",
    "global_linear",
]


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("foldcast-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    QUERIES["n_series"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
