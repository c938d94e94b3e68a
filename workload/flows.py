"""The flows end to end, from files written from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.plans.flows import (
    clean_customers,
    clean_orders,
    ingest_bronze,
    load_customers,
    load_orders,
    metrics_frame,
    run_orders,
)
from oreflow.sources.paths import scratch_path
from oreflow.sources.readers import create_reader
from oreflow.sources.snapshots import versioned_table
from oreflow.sources.writers import create_writer
from workload.gold import KPIS_SQL, money
from workload.inputs import (
    RAW_ORDERS_SQL,
    SILVER_CUSTOMERS_SQL,
    SILVER_ORDERS_SQL,
    raw_customers,
    raw_orders,
)


def comparable(df):
    """Without the time stamp, and with the total in a type both engines print alike."""
    return money(df.drop("_processing_ts"), "total_amount")


def bronze_ingest(spark, sf_dir):
    raw, bronze = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
    create_writer(spark, "csv").write(raw_orders(spark, sf_dir), raw)
    ingest_bronze(spark, raw, bronze)
    return create_reader(spark, "parquet").read(bronze)


def silver_orders(spark, sf_dir):
    return comparable(raw_orders(spark, sf_dir).transform(clean_orders()))


def silver_orders_loaded(spark, sf_dir):
    """Loaded twice: the second load must change nothing."""
    path = scratch_path(spark, "silver")
    for _ in range(2):
        load_orders(raw_orders(spark, sf_dir), path, partition_by=["status"])
    return comparable(versioned_table(spark, path).read())


def silver_customers(spark, sf_dir):
    return raw_customers(spark, sf_dir).transform(clean_customers()).drop(
        "_processing_ts", "phone", "city"
    )


def silver_customers_loaded(spark, sf_dir):
    path = scratch_path(spark, "silver")
    load_customers(raw_customers(spark, sf_dir), path)
    return versioned_table(spark, path).read().drop("_processing_ts", "phone", "city")


def whole_flow(spark, sf_dir):
    raw, base = scratch_path(spark, "raw"), scratch_path(spark, "lake")
    create_writer(spark, "csv").write(raw_orders(spark, sf_dir), raw)
    return run_orders(spark, raw, base), base


def orders_flow(spark, sf_dir):
    _, base = whole_flow(spark, sf_dir)
    return money(spark.read.parquet(f"{base}/gold/orders_kpis"), "revenue")


def orders_flow_checks(spark, sf_dir):
    _, base = whole_flow(spark, sf_dir)
    return spark.read.parquet(f"{base}/gold/dq_results").drop("details", "run_ts")


def run_metrics(spark, sf_dir):
    steps, _ = whole_flow(spark, sf_dir)
    return metrics_frame(spark, steps).select(
        "job",
        "rows_read",
        "rows_written",
        "rows_dropped",
        "dq_checks_passed",
        "dq_checks_failed",
        (F.col("elapsed_seconds") > 0).alias("timed"),
    )


_CUSTOMERS_SQL = f"""WITH {SILVER_CUSTOMERS_SQL}
  SELECT DISTINCT *, 'customers_etl' AS _pipeline_name, 'dev' AS _env FROM silver_customers"""


def _check(name, severity, failing):
    status = f"CASE WHEN {failing} = 0 THEN 'PASS' ELSE '{severity.upper()}' END"
    return f"""SELECT '{name}' AS check_name, 'orders_etl.silver_orders' AS dataset,
      {status} AS status, '{severity}' AS severity, count(*) AS total_rows,
      CAST({failing} AS BIGINT) AS failing_rows,
      CAST(count(*) - {failing} AS BIGINT) AS passing_rows,
      round(1.0 - CAST({failing} AS DOUBLE) / count(*), 6) AS pass_rate FROM silver"""


ENTRIES = {
    "bronze_ingest": (
        bronze_ingest,
        f"""WITH {RAW_ORDERS_SQL} SELECT * REPLACE (CAST(quantity AS VARCHAR) AS quantity,
              CAST(unit_price AS VARCHAR) AS unit_price, CAST(order_date AS VARCHAR)
              AS order_date) FROM raw_orders""",
    ),
    "silver_orders": (silver_orders, f"WITH {SILVER_ORDERS_SQL} SELECT * FROM silver"),
    "silver_orders_loaded": (
        silver_orders_loaded,
        f"WITH {SILVER_ORDERS_SQL} SELECT * FROM silver",
    ),
    "silver_customers": (silver_customers, _CUSTOMERS_SQL),
    "silver_customers_loaded": (silver_customers_loaded, _CUSTOMERS_SQL),
    "orders_flow": (orders_flow, KPIS_SQL),
    "orders_flow_checks": (
        orders_flow_checks,
        f"WITH {SILVER_ORDERS_SQL} "
        + " UNION ALL ".join(
            [
                _check("row_count", "warn", "0"),
                _check("not_null:order_id", "fail", "0"),
                _check("not_null:customer_id", "fail", "0"),
                _check("unique:order_id", "fail", "(count(*) - count(DISTINCT order_id))"),
                _check("range:unit_price", "fail", "count(*) FILTER (WHERE unit_price < 0)"),
                _check(
                    "accepted_values:status",
                    "warn",
                    "count(*) FILTER (WHERE status NOT IN ('PENDING', 'CONFIRMED', 'SHIPPED',"
                    " 'DELIVERED', 'CANCELLED', 'RETURNED'))",
                ),
            ]
        ),
    ),
    "run_metrics": (
        run_metrics,
        f"""WITH {SILVER_ORDERS_SQL}, n AS (
              SELECT (SELECT count(*) FROM raw_orders) AS raw_n,
                (SELECT count(*) FROM silver) AS silver_n,
                (SELECT count(DISTINCT status) FROM silver) AS gold_n)
            SELECT 'bronze_ingest' AS job, raw_n AS rows_read, raw_n AS rows_written,
              CAST(0 AS BIGINT) AS rows_dropped, CAST(0 AS BIGINT) AS dq_checks_passed,
              CAST(0 AS BIGINT) AS dq_checks_failed, TRUE AS timed FROM n
            UNION ALL SELECT 'orders_etl', raw_n, silver_n, raw_n - silver_n, 6, 0, TRUE FROM n
            UNION ALL SELECT 'gold.orders_kpis', silver_n, gold_n, silver_n - gold_n, 0, 0, TRUE
            FROM n
            UNION ALL SELECT 'gold.dq_summary', silver_n, gold_n, silver_n - gold_n, 0, 0, TRUE
            FROM n""",
    ),
}
