"""Transformers over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.operators.cleaning import (
    AddAuditColumns,
    AddIngestionColumns,
    CastColumns,
    ComputeDerivedColumns,
    DropDuplicates,
    DropNullKeys,
    EnforceSchema,
    FilterRows,
    KeepLatest,
    MaskPiiColumns,
    NormaliseStrings,
    RenameColumns,
    TrimStrings,
    compose,
)
from oreflow.sources.schemas import get_schema
from workload.inputs import RAW_ORDERS_SQL, raw_orders, table


def trim_strings(spark, sf_dir):
    return raw_orders(spark, sf_dir).transform(TrimStrings())


def trim_whitespace(spark, sf_dir):
    padded = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.concat(F.lit("\t \n"), "text", F.lit(" \n\t")).alias("text")
    )
    return padded.transform(TrimStrings(whitespace="all"))


def drop_duplicates_exact(spark, sf_dir):
    return raw_orders(spark, sf_dir).transform(DropDuplicates())


def drop_duplicates_key(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber"]
    return table(spark, sf_dir, "lineitem").transform(DropDuplicates(keys)).select(keys)


def drop_duplicates_null_key(spark, sf_dir):
    return raw_orders(spark, sf_dir).transform(DropDuplicates(["customer_id"])).select(
        "customer_id"
    )


def keep_latest(spark, sf_dir):
    keep = KeepLatest(["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return table(spark, sf_dir, "lineitem").transform(keep)


def drop_null_keys(spark, sf_dir):
    return raw_orders(spark, sf_dir).transform(
        DropNullKeys(["order_id", "customer_id", "not_a_column"])
    )


def cast_columns(spark, sf_dir):
    texts = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").cast("string").alias("part"),
        F.col("l_quantity").cast("string").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("price"),
        F.col("l_shipdate").cast("date").cast("string").alias("ship_date"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("not_a_number"),
    )
    return texts.transform(
        CastColumns(
            {
                "part": "long",
                "quantity": "integer",
                "price": "decimal(18,4)",
                "ship_date": "date",
                "flag": "boolean",
                "not_a_number": "double",
                "not_a_column": "date",
            }
        )
    )


def rename_columns(spark, sf_dir):
    return table(spark, sf_dir, "part").transform(
        RenameColumns(
            {"p_partkey": "key", "key": "product_id", "p_name": "product_name", "absent": "x"}
        )
    )


def normalise(case, columns=None):
    def query(spark, sf_dir):
        return table(spark, sf_dir, "part").transform(NormaliseStrings(columns, case))

    return query


def normalise_orders(spark, sf_dir):
    return raw_orders(spark, sf_dir).transform(NormaliseStrings(["status"], "upper"))


def derived_columns(spark, sf_dir):
    return raw_orders(spark, sf_dir).transform(
        ComputeDerivedColumns(
            {
                "total_amount": "cast(round(cast(quantity as decimal(18,4)) * unit_price, 2)"
                " as decimal(18,2))",
                "is_high_value": "total_amount > 1000000",
                "year_month": "date_format(order_date, 'yyyy-MM')",
                "label": "concat(product_id, ' ', coalesce(status, 'none'))",
                "status": "upper(coalesce(status, 'UNKNOWN'))",
                "status_length": "length(status)",
            }
        )
    )


def filter_rows(spark, sf_dir):
    return raw_orders(spark, sf_dir).transform(
        FilterRows("status != 'delivered' AND order_date >= '1998-01-01'")
    )


def audit_columns(spark, sf_dir):
    audited = table(spark, sf_dir, "orders").transform(AddAuditColumns("orders_etl", "prod"))
    return audited.withColumn("has_ts", F.col("_processing_ts").isNotNull()).drop("_processing_ts")


def ingestion_columns(spark, sf_dir):
    marked = table(spark, sf_dir, "orders").transform(AddIngestionColumns())
    return marked.select(
        "o_orderkey",
        F.col("_ingestion_ts").isNotNull().alias("has_ts"),
        F.regexp_extract("_source_file", "([^/]+)\\.parquet", 1).alias("source_table"),
    )


TARGET = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("unit_price", T.DecimalType(18, 2)),
        T.StructField("quantity", T.LongType()),
        T.StructField("not_there", T.StringType()),
    ]
)


def enforce_schema(spark, sf_dir):
    return raw_orders(spark, sf_dir).transform(EnforceSchema(TARGET, strict=False))


def enforce_schema_strict(spark, sf_dir):
    """Orders as text, with a column too many, in the registered schema."""
    texts = {c: F.col(c).cast("string") for c in ("quantity", "unit_price", "order_date")}
    rows = raw_orders(spark, sf_dir).withColumns({**texts, "note": F.lit("none")})
    return rows.transform(EnforceSchema(get_schema("raw.orders")))


def mask_pii(spark, sf_dir):
    return table(spark, sf_dir, "customer").transform(
        MaskPiiColumns(["c_name", "c_nationkey", "absent"], salt="pepper")
    )


def composed(spark, sf_dir):
    tidy = compose(TrimStrings(), DropNullKeys(["order_id"]))
    return raw_orders(spark, sf_dir).transform(
        compose(tidy, compose(), NormaliseStrings(["status", "channel"], "lower"))
    )


def raw_sql(select: str) -> str:
    return f"WITH {RAW_ORDERS_SQL} {select}"


_TRIMMED = """trim(order_id) AS order_id, trim(customer_id) AS customer_id,
  trim(product_id) AS product_id, quantity, unit_price, trim(status) AS status,
  order_date, trim(channel) AS channel"""

ENTRIES = {
    "trim_strings": (trim_strings, raw_sql(f"SELECT {_TRIMMED} FROM raw_orders")),
    "trim_whitespace": (
        trim_whitespace,
        r"""SELECT conv_id, turn, role, regexp_replace(chr(9) || ' ' || chr(10) || text || ' ' || chr(10)
            || chr(9), '^\s+|\s+$', '', 'g') AS text FROM conversations""",
    ),
    "drop_duplicates_exact": (drop_duplicates_exact, raw_sql("SELECT DISTINCT * FROM raw_orders")),
    "drop_duplicates_key": (
        drop_duplicates_key,
        "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    ),
    "drop_duplicates_null_key": (
        drop_duplicates_null_key,
        raw_sql("SELECT DISTINCT customer_id FROM raw_orders"),
    ),
    "keep_latest": (
        keep_latest,
        """SELECT * EXCLUDE (place) FROM (
             SELECT *, row_number() OVER (
               PARTITION BY l_orderkey, l_linenumber
               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                 l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                 l_linestatus DESC) AS place
             FROM lineitem) WHERE place = 1""",
    ),
    "drop_null_keys": (
        drop_null_keys,
        raw_sql(
            "SELECT * FROM raw_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL"
        ),
    ),
    "cast_columns": (
        cast_columns,
        """SELECT l_orderkey, l_linenumber, l_partkey AS part,
             CAST(trunc(l_quantity) AS INTEGER) AS quantity,
             CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS price,
             CAST(l_shipdate AS DATE) AS ship_date,
             CASE WHEN l_returnflag = 'N' THEN FALSE END AS flag,
             CAST(NULL AS DOUBLE) AS not_a_number
           FROM lineitem""",
    ),
    "rename_columns": (
        rename_columns,
        """SELECT p_partkey AS product_id, p_name AS product_name, p_brand, p_type, p_size,
             p_retailprice FROM part""",
    ),
    "normalise_upper": (
        normalise("upper"),
        """SELECT p_partkey, upper(p_name) AS p_name, upper(p_brand) AS p_brand,
             upper(p_type) AS p_type, p_size, p_retailprice FROM part""",
    ),
    "normalise_lower": (
        normalise("lower", ["p_brand", "p_type", "absent"]),
        """SELECT p_partkey, p_name, lower(p_brand) AS p_brand, lower(p_type) AS p_type, p_size,
             p_retailprice FROM part""",
    ),
    "normalise_title": (
        normalise("title", ["p_name"]),
        """SELECT p_partkey, array_to_string(list_transform(string_split(lower(p_name), ' '),
             lambda w: upper(w[1]) || w[2:]), ' ') AS p_name, p_brand, p_type, p_size,
             p_retailprice FROM part""",
    ),
    "normalise_orders": (
        normalise_orders,
        raw_sql("SELECT * REPLACE (upper(status) AS status) FROM raw_orders"),
    ),
    "derived_columns": (
        derived_columns,
        raw_sql(
            """, d AS (SELECT *, CAST(round(CAST(quantity AS DECIMAL(18,4)) * unit_price, 2)
                 AS DECIMAL(18,2)) AS total_amount FROM raw_orders)
               SELECT * REPLACE (upper(coalesce(status, 'UNKNOWN')) AS status),
                 total_amount > 1000000 AS is_high_value,
                 strftime(order_date, '%Y-%m') AS year_month,
                 product_id || ' ' || coalesce(status, 'none') AS label,
                 CAST(length(coalesce(status, 'UNKNOWN')) AS INTEGER) AS status_length
               FROM d"""
        ),
    ),
    "filter_rows": (
        filter_rows,
        raw_sql(
            """SELECT * FROM raw_orders
               WHERE status != 'delivered' AND order_date >= DATE '1998-01-01'"""
        ),
    ),
    "audit_columns": (
        audit_columns,
        """SELECT *, 'orders_etl' AS _pipeline_name, 'prod' AS _env, TRUE AS has_ts
           FROM orders""",
    ),
    "ingestion_columns": (
        ingestion_columns,
        "SELECT o_orderkey, TRUE AS has_ts, 'orders' AS source_table FROM orders",
    ),
    "enforce_schema": (
        enforce_schema,
        raw_sql(
            """SELECT order_id, order_date, CAST(unit_price AS DECIMAL(18,2)) AS unit_price,
                 CAST(quantity AS BIGINT) AS quantity FROM raw_orders"""
        ),
    ),
    "enforce_schema_strict": (enforce_schema_strict, raw_sql("SELECT * FROM raw_orders")),
    "mask_pii": (
        mask_pii,
        """SELECT c_custkey, sha256(c_name || 'pepper') AS c_name,
             sha256(c_nationkey || 'pepper') AS c_nationkey, c_acctbal, c_mktsegment
           FROM customer""",
    ),
    "composed_steps": (
        composed,
        raw_sql(
            """SELECT trim(order_id) AS order_id, trim(customer_id) AS customer_id,
                 trim(product_id) AS product_id, quantity, unit_price,
                 lower(trim(status)) AS status, order_date, lower(trim(channel)) AS channel
               FROM raw_orders WHERE order_id IS NOT NULL"""
        ),
    ),
}
