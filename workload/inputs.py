"""Orders and customers in raw form, with dirt, derived from the given tables.

The tables themselves are clean. Missing values, padding and re-delivered rows come from
the orders' own status, priority and price, the same way here and in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order, filled orders a second time, and a later state of pending ones.

    An open order of unspecified priority has no id, a cheap one no customer, and a
    pending one no status until its later state arrives.
    """
    orders = table(spark, sf_dir, "orders")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    nameless = (priority == "4-NOT SPECIFIED") & (status == "O")
    first = orders.select(
        F.when(~nameless, F.concat(F.lit("ORD-"), "o_orderkey")).alias("order_id"),
        F.when(F.col("o_totalprice") >= 20000, F.concat(F.lit("CUST-"), "o_custkey")).alias(
            "customer_id"
        ),
        F.concat(F.lit("PROD-"), F.substring(priority, 1, 1)).alias("product_id"),
        F.substring(priority, 1, 1).cast("int").alias("quantity"),
        F.col("o_totalprice").cast("decimal(18,4)").alias("unit_price"),
        F.when(status == "O", " pending ").when(status == "F", "delivered").alias("status"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.concat(F.lit("  "), F.lower(F.substring(priority, 3, 20))).alias("channel"),
        status.alias("kind"),
    )
    copies = first.filter("kind = 'F'")
    later = first.filter("kind = 'P'").withColumns(
        {"status": F.lit("Confirmed "), "order_date": F.date_add("order_date", 1)}
    )
    return first.unionAll(copies).unionAll(later).drop("kind")


RAW_ORDERS_SQL = """
first_state AS (
  SELECT CASE WHEN NOT (o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O')
              THEN 'ORD-' || o_orderkey END AS order_id,
         CASE WHEN o_totalprice >= 20000 THEN 'CUST-' || o_custkey END AS customer_id,
         'PROD-' || substr(o_orderpriority, 1, 1) AS product_id,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS quantity,
         CAST(o_totalprice AS DECIMAL(18,4)) AS unit_price,
         CASE o_orderstatus WHEN 'O' THEN ' pending ' WHEN 'F' THEN 'delivered' END AS status,
         CAST(o_orderdate AS DATE) AS order_date,
         '  ' || lower(substr(o_orderpriority, 3, 20)) AS channel,
         o_orderstatus AS kind
  FROM orders
),
raw_orders AS (
  SELECT * EXCLUDE (kind) FROM first_state
  UNION ALL
  SELECT * EXCLUDE (kind) FROM first_state WHERE kind = 'F'
  UNION ALL
  SELECT order_id, customer_id, product_id, quantity, unit_price, 'Confirmed ' AS status,
         order_date + 1 AS order_date, channel
  FROM first_state WHERE kind = 'P'
)
"""

_SILVER_COLUMNS = """order_id, customer_id, product_id, quantity, unit_price, order_date, channel,
         upper(coalesce(status, 'UNKNOWN')) AS status,
         CAST(round(CAST(quantity AS DECIMAL(18,4)) * unit_price, 2) AS DECIMAL(18,2))
           AS total_amount"""

SILVER_ORDERS_SQL = (
    RAW_ORDERS_SQL
    + f""",
trimmed AS (
  SELECT trim(order_id) AS order_id, trim(customer_id) AS customer_id,
         trim(product_id) AS product_id, quantity, unit_price, trim(status) AS status,
         order_date, trim(channel) AS channel
  FROM raw_orders
),
ranked AS (
  SELECT *, row_number() OVER (
      PARTITION BY order_id
      ORDER BY order_date DESC NULLS LAST, customer_id DESC NULLS LAST,
               product_id DESC NULLS LAST, quantity DESC NULLS LAST,
               unit_price DESC NULLS LAST, status DESC NULLS LAST, channel DESC NULLS LAST
    ) AS place
  FROM trimmed WHERE order_id IS NOT NULL
),
silver AS (
  SELECT {_SILVER_COLUMNS}, 'orders_etl' AS _pipeline_name, 'dev' AS _env
  FROM ranked WHERE place = 1 AND customer_id IS NOT NULL
)
"""
)


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in the raw schema; building-segment ones come again with a later date and
    with text that is none."""
    customer = table(spark, sf_dir, "customer")
    parts = F.split("c_name", "#")
    first = customer.select(
        F.concat(F.lit("CUST-"), "c_custkey").alias("customer_id"),
        F.concat(F.lit(" "), F.lower(parts[0])).alias("first_name"),
        F.concat(F.lit("n"), parts[1]).alias("last_name"),
        F.concat(F.lower(parts[0]), parts[1], F.lit("@example.com ")).alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.when(F.col("c_nationkey") > 0, F.concat(F.lit("n"), "c_nationkey")).alias("country"),
        F.lit(None).cast("string").alias("city"),
        F.when(F.col("c_acctbal") > 0, "2024-01-15").otherwise("unknown").alias("signup_date"),
        F.col("c_mktsegment").alias("segment"),
    )
    again = first.filter("segment = 'BUILDING'")
    later = again.withColumn("signup_date", F.lit("2024-03-01"))
    return first.unionAll(later).unionAll(again.withColumn("signup_date", F.lit("pending")))


RAW_CUSTOMERS_SQL = """
raw_customers AS (
  SELECT 'CUST-' || c_custkey AS customer_id,
         ' ' || lower(split_part(c_name, '#', 1)) AS first_name,
         'n' || split_part(c_name, '#', 2) AS last_name,
         lower(split_part(c_name, '#', 1)) || split_part(c_name, '#', 2) || '@example.com '
           AS email,
         CASE WHEN c_nationkey > 0 THEN 'n' || c_nationkey END AS country,
         CASE WHEN c_acctbal > 0 THEN '2024-01-15' ELSE 'unknown' END AS signup_date,
         c_mktsegment AS segment
  FROM customer
),
delivered_customers AS (
  SELECT * FROM raw_customers
  UNION ALL SELECT * REPLACE ('2024-03-01' AS signup_date) FROM raw_customers WHERE segment = 'BUILDING'
  UNION ALL SELECT * REPLACE ('pending' AS signup_date) FROM raw_customers WHERE segment = 'BUILDING'
),
ranked_customers AS (
  SELECT *, row_number() OVER (
      PARTITION BY customer_id ORDER BY TRY_CAST(signup_date AS DATE) DESC NULLS LAST) AS place
  FROM delivered_customers
)
"""

SILVER_CUSTOMERS_SQL = (
    RAW_CUSTOMERS_SQL
    + """,
silver_customers AS (
  SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
         trim(email) AS email, country, TRY_CAST(signup_date AS DATE) AS signup_date, segment,
         upper(substr(trim(first_name), 1, 1)) || lower(substr(trim(first_name), 2))
           || ' ' || upper(trim(last_name)) AS full_name,
         upper(coalesce(country, 'UNKNOWN')) AS country_code
  FROM ranked_customers WHERE place = 1
)
"""
)
