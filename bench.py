"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  folder of the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from echoloom.registry import QUERIES  # noqa: E402

HEADLINE = (
    "medallion",
    "clean_text",
    "normalize_for_scoring",
    "dedup_reviews",
    "sentiment_distribution",
    "topic_sentiment_breakdown",
    "summary_report",
    "analysis_result",
    "stratified_split_orders",
    "tfidf_terms",
    "tfidf_features",
    "eval_metrics",
    "train_logreg",
    "score_reviews",
    "embed_text",
    "reduce_text",
    "knn_graph",
    "density_cluster",
    "cluster_keywords",
    "topic_discovery",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("echoloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("sentiment_distribution")  # start the executors before the clock
    seconds = {name: run(name) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
