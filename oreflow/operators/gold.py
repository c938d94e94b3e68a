"""Gold aggregates. Each shuffles one partial row per key and task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gold_kpis(silver: DataFrame) -> DataFrame:
    """Revenue and number of orders by status."""
    return silver.groupBy("status").agg(
        F.sum("total_amount").alias("revenue"), F.count("order_id").alias("nb_orders")
    )


def status_summary(silver: DataFrame) -> DataFrame:
    return silver.groupBy("status").agg(F.count(F.lit(1)).alias("nb_orders"))


def daily_sales(silver: DataFrame) -> DataFrame:
    """Orders, units and revenue by order date."""
    return silver.groupBy("order_date").agg(
        F.count(F.lit(1)).alias("nb_orders"),
        F.sum(F.col("quantity").cast("long")).alias("units"),
        F.sum("total_amount").alias("revenue"),
    )


def customer_360(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Every customer with the totals of their orders.

    Orders are reduced to one row per customer first, so a customer with a third of all
    orders joins as one row, and the join reuses the aggregate's partitioning.
    """
    per_customer = (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("nb_orders"),
            F.sum("total_amount").alias("revenue"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
    )
    return customers.join(per_customer, "customer_id", "left").fillna(0, ["nb_orders"])


def dq_trend(results: DataFrame) -> DataFrame:
    """Mean pass rate and number of runs by dataset, check and day of run (UTC)."""
    day = F.to_date(F.substring("run_ts", 1, 10))
    return results.groupBy("dataset", "check_name", day.alias("run_date")).agg(
        F.avg("pass_rate").alias("avg_pass_rate"), F.count(F.lit(1)).alias("nb_runs")
    )
