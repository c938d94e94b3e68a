"""Explicit schemas, looked up as "<zone>.<dataset>".

Raw columns may be NULL. Money is decimal(18,4), except the derived ``total_amount``,
whose type follows from rounding quantity times price to two places.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "money": T.DecimalType(18, 4),
    "total": T.DecimalType(32, 2),
    "revenue": T.DecimalType(38, 2),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


def _schema(required: str = "", **columns: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t], n != required) for n, t in columns.items()])


RAW_ORDERS_SCHEMA = _schema(
    order_id="string",
    customer_id="string",
    product_id="string",
    quantity="int",
    unit_price="money",
    status="string",
    order_date="date",
    channel="string",
)

RAW_CUSTOMERS_SCHEMA = _schema(
    customer_id="string",
    first_name="string",
    last_name="string",
    email="string",
    phone="string",
    country="string",
    city="string",
    signup_date="string",
    segment="string",
    _ingestion_ts="timestamp",
)

RAW_PRODUCTS_SCHEMA = _schema(
    product_id="string",
    product_name="string",
    category="string",
    list_price="string",
    is_active="string",
    _ingestion_ts="timestamp",
)

SILVER_ORDERS_SCHEMA = _schema(
    "order_id",
    order_id="string",
    customer_id="string",
    product_id="string",
    quantity="int",
    unit_price="money",
    status="string",
    order_date="date",
    channel="string",
    total_amount="total",
    _processing_ts="timestamp",
    _pipeline_name="string",
    _env="string",
)

SILVER_CUSTOMERS_SCHEMA = _schema(
    "customer_id",
    customer_id="string",
    first_name="string",
    last_name="string",
    email="string",
    phone="string",
    country="string",
    city="string",
    signup_date="date",
    segment="string",
    full_name="string",
    country_code="string",
    _processing_ts="timestamp",
    _pipeline_name="string",
    _env="string",
)

SILVER_PRODUCTS_SCHEMA = _schema(
    "product_id",
    product_id="string",
    product_name="string",
    category="string",
    list_price="money",
    is_active="boolean",
    _processing_ts="timestamp",
)

GOLD_DAILY_SALES_SCHEMA = _schema(
    order_date="date", nb_orders="long", units="long", revenue="revenue"
)

GOLD_CUSTOMER_360_SCHEMA = _schema(
    "customer_id",
    customer_id="string",
    full_name="string",
    country_code="string",
    nb_orders="long",
    revenue="revenue",
    first_order_date="date",
    last_order_date="date",
)

SCHEMA_REGISTRY: dict[str, T.StructType] = {
    "raw.orders": RAW_ORDERS_SCHEMA,
    "raw.customers": RAW_CUSTOMERS_SCHEMA,
    "raw.products": RAW_PRODUCTS_SCHEMA,
    "silver.orders": SILVER_ORDERS_SCHEMA,
    "silver.customers": SILVER_CUSTOMERS_SCHEMA,
    "silver.products": SILVER_PRODUCTS_SCHEMA,
    "gold.daily_sales": GOLD_DAILY_SALES_SCHEMA,
    "gold.customer_360": GOLD_CUSTOMER_360_SCHEMA,
}


def get_schema(dataset: str) -> T.StructType:
    if dataset not in SCHEMA_REGISTRY:
        raise KeyError(f"unknown schema {dataset!r}; known: {sorted(SCHEMA_REGISTRY)}")
    return SCHEMA_REGISTRY[dataset]
