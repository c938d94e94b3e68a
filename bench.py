"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local cores. Every query runs
in full twice and the second run counts, so that the time is not that of the JVM's first
compilation; "first" has the first runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "trim_strings",
    "drop_duplicates_exact",
    "drop_duplicates_key",
    "keep_latest",
    "cast_columns",
    "derived_columns",
    "mask_pii",
    "dq_uniqueness",
    "dq_suite",
    "dq_referential",
    "silver_orders",
    "gold_kpis",
    "daily_sales",
    "customer_360",
    "upsert",
    "upsert_partitioned",
    "version_diff",
    "csv_round_trip",
    "orders_flow",
    "stream_ingest",
]


def make_session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("oreflow")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    from workload import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = make_session(os.environ.get("BENCH_CPUS", "8"))
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("sum(l_quantity)").collect()
    first, times = {}, {}
    for results in (first, times):
        for name in HEADLINE:
            start = time.monotonic()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            results[name] = round(time.monotonic() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "first": first,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
