"""Time the headline queries and print one JSON line.

Every query starts from the raw Parquet tables; nothing is kept between queries. The first run of
a small query, which pays for JVM start and code generation, is not counted. Each query's seconds go to
standard error as it ends. After BENCH_LIMIT seconds, or when asked to end, the line is printed with
the queries that have finished; the others are named in it.
"""

import json
import os
import signal
import sys
import time

from pyspark.sql import SparkSession

from lapsewise.queries import callables
from lapsewise.sources.workspace import release

HEADLINE = [
    "churn_and_engagement_by_mode",
    "player_profile",
    "loss_streak",
    "remove_duplicates",
    "winsorise",
    "describe_numerics",
    "rfm_score",
    "engineer_features",
    "preprocess_matrix",
    "kpi_row",
    "churn_by_mode",
    "recency_histogram",
    "box_stats",
    "correlation_matrix",
    "cohort_retention",
    "engagement_funnel",
    "running_order_counts",
    "quantiles_by_status",
    "revenue_pareto",
    "stratified_split",
    "pr_curve",
    "comparison_table",
    "risk_table",
    "validate_records",
    "segment_profile",
    "davies_bouldin",
    "sessionize",
    "rolling_activity_7d",
    "stream_daily_counts",
    "smote_rows",
    "kmeans_segment_profile",
    "kmeans_scan",
    "tree_waterfall",
    "tree_contributions",
    "model_comparison",
]


class Ended(Exception):
    """The time is up."""


def end(*_) -> None:
    raise Ended


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run = callables()
    run["churn_overview"](spark, sf_dir).collect()
    seconds = {}
    for sign in (signal.SIGTERM, signal.SIGALRM):
        signal.signal(sign, end)
    signal.alarm(int(os.environ.get("BENCH_LIMIT", "1500")))
    try:
        for name in HEADLINE:
            start = time.perf_counter()
            run[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
            print(name, seconds[name], file=sys.stderr, flush=True)
    except Ended:
        pass
    signal.alarm(0)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "unfinished": [name for name in HEADLINE if name not in seconds],
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }), flush=True)
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
