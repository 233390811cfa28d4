"""Times the headline queries once each and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local threads.
Set BENCH_QUERIES to a comma-separated list, or ``all``, to time other registered queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from casecurve.plans.catalog import QUERIES
from casecurve.session import build_session

HEADLINE = [
    "monthly_cases_lineitem",
    "scan_historical",
    "anomaly_table",
    "daily_cases",
    "surveillance_summary",
    "seasonal_baseline",
    "alert_messages",
    "holt_winters_fit",
    "sarima_forecast",
    "holdout_metrics_seasonal",
    "backtest_metrics_sarima",
    "region_rollup",
    "describe_by_class",
    "impute_median",
    "linear_fit_by_group",
    "duplicate_texts",
    "stratified_split_orders",
    "pr_threshold",
    "roc_auc",
    "class_report",
    "harmonise_imputed",
    "gaussian_nb",
    "knn_vote",
    "knn_vote_cells",
    "logreg_score",
    "screen_with_context",
    "stream_alerts",
    "cv_accuracy",
    "tuned_forest_metrics",
    "model_compare",
    "retrain_all",
    "sarima_exact_forecast",
    "trend_yearly_forecast",
    "logistic_cross_validation",
    "stream_complete_windows",
    "patient_search_indexed",
    "counts_kept_up_to_date",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    wanted = os.environ.get("BENCH_QUERIES")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = build_session(
        "casecurve-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One read before the clock starts, so that no query pays for starting the engine.
    QUERIES["monthly_cases"](spark, folder).collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
