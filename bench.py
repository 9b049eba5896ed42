"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR  input folder (default /root/testdata/sf0.1)
    BENCH_CPUS    cores of the local session (default 8)

Every query runs whole (all rows, all columns, into a sink that drops them), once
to warm up and then twice; the better of the two counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from factpanel.queries import queries

HEADLINE = [
    "fundamentals", "tag_pivot", "facts_semi_join", "panel_full", "panel_ttm_yoy",
    "simple_screener", "screener_merge", "value_screen_latest", "rank_metric",
    "latest_by_rank", "coverage_classify", "quarter_audit", "sub_integrity",
    "company_ttm", "compare_companies", "validate_panel", "month_rollup", "profile_columns", "histogram_2d", "line_findings", "pl_bridge",
]


def run(query, spark, sf_dir) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    names = list(known) if "--all" in sys.argv else HEADLINE
    cold, warm = {}, {}
    for name in names:
        cold[name] = round(run(known[name], spark, sf_dir), 3)
        warm[name] = round(min(run(known[name], spark, sf_dir) for _ in range(2)), 3)
    spark.stop()
    line = {
        "metric": "total_warm_query_time",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "master": f"local[{cpus}]",
        "shuffle_partitions": int(cpus),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
