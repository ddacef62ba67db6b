"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from checks.queries import QUERIES
from tidewatch.session import builder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "churn_label", "no_sales_streak", "account_windows", "account_window_sales", "purchase_interval",
    "monthly_sales", "peer_means", "rotation", "club_movement", "financial_month", "credit_notes",
    "order_channel", "claim_counts", "visit_counts", "monthly_wide", "account_features",
    "encode_features", "quality_report", "column_profile", "iqr_outliers", "roc_auc",
    "prediction_summary", "explanations", "train_quick", "tree_contributions",
)


def main() -> None:
    spark = (
        builder("bench").master(f"local[{CPUS}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    # One unmeasured run starts the JVM's compilers; each query is then timed once.
    QUERIES["account_windows"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
