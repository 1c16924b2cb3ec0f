"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every query runs
whole into a sink that discards rows; one small run warms the session up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from registry.queries import QUERIES

HEADLINE = (
    "read_entities_xml", "read_relationships_xml", "normalize_name", "clean_name",
    "build_source_list", "merge_membership", "match_crosswalk", "match_page_titles",
    "block_candidates", "review_candidates", "match_summary", "in_relationships",
    "distinct_edges", "undirected_degree", "top_in_degree", "network_stats",
    "sample_per_group", "label_counts", "quality_checks", "all_run_metrics",
)


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("firmloom bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        run(spark, "match_crosswalk", small)
    seconds = {name: round(run(spark, name, sf_dir), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
