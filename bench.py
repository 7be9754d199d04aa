"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the
data and the local cores.  Each query is planned and run to the end into a sink
that keeps nothing, BENCH_RUNS times (default 3), and the median counts; once the
whole run has taken BENCH_LIMIT seconds (default 300), one run each must do.  The
session is warmed up by one small query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scorefold.plans.registry import QUERIES  # noqa: E402

HEADLINE = [
    "unpivot_scores", "pivot_scores", "student_features", "student_features_rowwise", "student_features_wide",
    "field_gpa", "field_gpa_long", "student_card", "subject_stats", "subject_analysis_all", "subject_grouped_list",
    "subject_report_lines", "dedupe_last", "filter_codes_table", "table_search_literal", "market_flatten",
    "market_report", "competitiveness", "career_analysis", "group_share", "assign_fixed_centres",
    "silhouette_fixed_centres", "choose_k", "page_headings", "page_count_phrases",
    "kmeans_risk", "kmeans_subject", "k_sweep",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("scorefold-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["row_count"](spark, sf_dir).collect()
    seconds, began = {}, time.perf_counter()
    runs, limit = int(os.environ.get("BENCH_RUNS", "3")), float(os.environ.get("BENCH_LIMIT", "300"))
    for name in HEADLINE:
        taken = []
        while not taken or (len(taken) < runs and time.perf_counter() - began < limit):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
