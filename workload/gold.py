"""Gold aggregates over the silver orders of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.operators import gold
from oreflow.plans.flows import clean_customers, clean_orders
from workload.inputs import (
    SILVER_CUSTOMERS_SQL,
    SILVER_ORDERS_SQL,
    raw_customers,
    raw_orders,
)


def silver_orders(spark, sf_dir):
    return raw_orders(spark, sf_dir).transform(clean_orders())


def money(df, *names):
    return df.withColumns({n: F.col(n).cast("decimal(18,2)") for n in names})


def gold_kpis(spark, sf_dir):
    return money(gold.gold_kpis(silver_orders(spark, sf_dir)), "revenue")


def status_summary(spark, sf_dir):
    return gold.status_summary(silver_orders(spark, sf_dir))


def daily_sales(spark, sf_dir):
    return money(gold.daily_sales(silver_orders(spark, sf_dir)), "revenue")


def ordered_sales(spark, sf_dir):
    return daily_sales(spark, sf_dir).orderBy(F.desc("revenue"), "order_date")


def customer_360(spark, sf_dir):
    customers = (
        raw_customers(spark, sf_dir)
        .transform(clean_customers())
        .select("customer_id", "full_name", "country_code")
    )
    return money(gold.customer_360(customers, silver_orders(spark, sf_dir)), "revenue")


KPIS_SQL = f"""WITH {SILVER_ORDERS_SQL}
  SELECT status, CAST(sum(total_amount) AS DECIMAL(18,2)) AS revenue,
    count(order_id) AS nb_orders FROM silver GROUP BY status"""
STATUS_SQL = f"""WITH {SILVER_ORDERS_SQL}
  SELECT status, count(*) AS nb_orders FROM silver GROUP BY status"""

SALES_SQL = f"""WITH {SILVER_ORDERS_SQL}
  SELECT order_date, count(*) AS nb_orders, CAST(sum(quantity) AS BIGINT) AS units,
    CAST(sum(total_amount) AS DECIMAL(18,2)) AS revenue
  FROM silver GROUP BY order_date"""

ENTRIES = {
    "gold_kpis": (gold_kpis, KPIS_SQL),
    "status_summary": (status_summary, STATUS_SQL),
    "daily_sales": (daily_sales, SALES_SQL),
    "daily_sales_ordered": (ordered_sales, f"{SALES_SQL} ORDER BY revenue DESC, order_date"),
    "customer_360": (
        customer_360,
        f"""WITH {SILVER_ORDERS_SQL}, {SILVER_CUSTOMERS_SQL},
            c AS (SELECT DISTINCT customer_id, full_name, country_code FROM silver_customers)
            SELECT c.*, count(s.order_id) AS nb_orders,
              CAST(sum(s.total_amount) AS DECIMAL(18,2)) AS revenue,
              min(s.order_date) AS first_order_date, max(s.order_date) AS last_order_date
            FROM c LEFT JOIN silver s ON s.customer_id = c.customer_id
            GROUP BY ALL""",
    ),
}
