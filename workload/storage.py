"""Readers, writers and versioned tables. Each query writes to a folder of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.functions.layout import repartition_by_size
from oreflow.sources.paths import scratch_path
from oreflow.sources.readers import create_reader
from oreflow.sources.schemas import RAW_ORDERS_SCHEMA
from oreflow.sources.snapshots import SnapshotTable
from oreflow.sources.writers import create_writer, register_table, write_raw
from workload.inputs import RAW_ORDERS_SQL, raw_orders, table


def parquet_scan(spark, sf_dir):
    lines = create_reader(spark, "Parquet").read(f"{sf_dir}/lineitem.parquet")
    return lines.filter("l_quantity > 25 AND l_returnflag = 'R'").select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


def csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    create_writer(spark, "csv").write(raw_orders(spark, sf_dir), path, sep=";")
    return create_reader(spark, "csv").read(path, schema=RAW_ORDERS_SCHEMA, sep=";")


def csv_strings(spark, sf_dir):
    path = scratch_path(spark, "csv")
    create_writer(spark, "csv").write(raw_orders(spark, sf_dir), path)
    return create_reader(spark, "csv").read(path)


def json_round_trip(spark, sf_dir):
    path = scratch_path(spark, "json")
    documents = table(spark, sf_dir, "documents")
    documents.write.json(path)
    return create_reader(spark, "json").read(path, schema=documents.schema)


def partitioned_write(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    create_writer(spark, "parquet").write(
        table(spark, sf_dir, "lineitem"),
        path,
        partition_by=["l_returnflag", "l_linestatus"],
        rebalanced=True,
    )
    return spark.read.parquet(path)


def dynamic_overwrite(spark, sf_dir):
    """Only the partition the second write has rows for is replaced."""
    path, writer = scratch_path(spark, "parquet"), create_writer(spark, "parquet")
    orders = table(spark, sf_dir, "orders")
    writer.write(orders, path, partition_by=["o_orderstatus"])
    pending = orders.filter("o_orderstatus = 'P'").withColumn("o_totalprice", F.lit(0.0))
    writer.write(pending, path, partition_by=["o_orderstatus"], dynamic_overwrite=True)
    return spark.read.parquet(path)


def merged_schemas(spark, sf_dir):
    """Files with and without a column, read with ``merge_schema``."""
    path, writer = scratch_path(spark, "parquet"), create_writer(spark, "parquet")
    customer = table(spark, sf_dir, "customer")
    writer.write(customer.drop("c_acctbal").filter("c_mktsegment = 'BUILDING'"), path)
    writer.write(customer.filter("c_mktsegment != 'BUILDING'"), path, mode="append")
    return create_reader(spark, "parquet").read(path, merge_schema=True)


def raw_by_day(spark, sf_dir):
    path = scratch_path(spark, "raw")
    events = table(spark, sf_dir, "events")
    write_raw(events.withColumn("_ingestion_ts", F.col("ts").cast("timestamp")), path)
    return spark.read.parquet(path).drop("_ingestion_ts")


def right_sized_files(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    sized = repartition_by_size(table(spark, sf_dir, "lineitem"), 128, 5120)
    create_writer(spark, "parquet").write(sized, path)
    files = F.count_distinct("_metadata.file_name").alias("n_files")
    return spark.read.parquet(path).agg(files, F.count(F.lit(1)).alias("n_rows"))


def registered_table(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    name = "default.orders_" + path[-8:]
    create_writer(spark, "parquet").write(table(spark, sf_dir, "orders"), path)
    register_table(spark, name, path)
    register_table(spark, name, path)
    rows = create_reader(spark, "table").read(name)
    spark.sql(f"DROP TABLE {name}")  # the name only; the files and `rows` stay
    return rows


# -- versioned tables: filled and open orders are loaded, then open and pending ones come in


def base_and_changes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_totalprice", F.col("o_totalprice").cast("decimal(18,2)")
    )
    base = orders.filter("o_orderstatus IN ('F', 'O')")
    changes = orders.filter("o_orderstatus IN ('O', 'P')").withColumns(
        {
            "o_totalprice": (F.col("o_totalprice") + 1).cast("decimal(18,2)"),
            "o_orderpriority": F.lit("changed"),
        }
    )
    return base, changes


def loaded(spark, sf_dir, partition_by=None, **upsert):
    """A table with the base as version 0 and the changes merged in as version 1."""
    base, changes = base_and_changes(spark, sf_dir)
    orders = SnapshotTable(spark, scratch_path(spark, "orders"))
    orders.upsert(base, ["o_orderkey"], partition_by=partition_by)
    orders.upsert(changes, ["o_orderkey"], **upsert)
    return orders, changes


def upsert(spark, sf_dir):
    return loaded(spark, sf_dir)[0].read()


def upsert_replayed(spark, sf_dir):
    orders, changes = loaded(spark, sf_dir)
    orders.upsert(changes, ["o_orderkey"])
    return orders.read()


def upsert_partitioned(spark, sf_dir):
    return loaded(spark, sf_dir, partition_by=["o_orderstatus"])[0].read()


def upsert_bucketed(spark, sf_dir):
    """The changes into a table of 16 buckets by order key."""
    base, changes = base_and_changes(spark, sf_dir)
    orders = SnapshotTable(spark, scratch_path(spark, "orders"))
    orders.upsert(base, ["o_orderkey"], buckets=16)
    orders.upsert(changes, ["o_orderkey"])
    return orders.read()


def upsert_text_pruned(spark, sf_dir):
    """The last day's changes into a table with hashes for keys, written status by status."""
    base, changes = base_and_changes(spark, sf_dir)
    key = F.md5(F.col("o_orderkey").cast("string"))
    orders = SnapshotTable(spark, scratch_path(spark, "orders"))
    for status in ("F", "O"):
        part = base.filter(F.col("o_orderstatus") == status)
        orders.write(part.withColumn("text_key", key), index_by=["text_key"])
    last = changes.agg(F.max("o_orderdate").alias("last"))
    latest = changes.join(F.broadcast(last), F.col("o_orderdate") == F.col("last")).drop("last")
    orders.upsert(latest.withColumn("text_key", key), ["text_key"])
    return orders.read()


def upsert_columns(spark, sf_dir):
    return loaded(spark, sf_dir, update_columns=["o_orderpriority"])[0].read()


def text_keyed(spark, sf_dir, **upsert):
    """The changes come in with their keys as text."""
    base, changes = base_and_changes(spark, sf_dir)
    orders = SnapshotTable(spark, scratch_path(spark, "orders"))
    orders.upsert(base, ["o_orderkey"])
    changes = changes.withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
    orders.upsert(changes, ["o_orderkey"], **upsert)
    return orders.read()


def upsert_text_keys(spark, sf_dir):
    return text_keyed(spark, sf_dir, update_columns=["o_orderpriority"])


def upsert_text_keys_delete(spark, sf_dir):
    return text_keyed(
        spark, sf_dir, delete_condition="source.o_totalprice > 300000 AND target.o_custkey > 10"
    )


def upsert_delete(spark, sf_dir):
    return loaded(
        spark, sf_dir, delete_condition="source.o_totalprice > 300000 AND target.o_custkey > 10"
    )[0].read()


def upsert_null_keys(spark, sf_dir):
    """Rows with a NULL key match nothing, so a replay inserts them again."""
    rows = raw_orders(spark, sf_dir).dropDuplicates()
    one = rows.groupBy("customer_id", "order_id").agg(F.max("order_date").alias("order_date"))
    orders = SnapshotTable(spark, scratch_path(spark, "orders"))
    for _ in range(2):
        orders.upsert(one, ["customer_id", "order_id"])
    return orders.read()


def append_versions(spark, sf_dir):
    base, changes = base_and_changes(spark, sf_dir)
    path, writer = scratch_path(spark, "orders"), create_writer(spark, "delta")
    writer.write(base, path)
    writer.write(changes, path)
    return create_reader(spark, "delta").read(path)


def time_travel(spark, sf_dir):
    return loaded(spark, sf_dir)[0].read(version=0)


def time_travel_timestamp(spark, sf_dir):
    orders, _ = loaded(spark, sf_dir)
    return orders.read(timestamp=orders.snapshot(0).committed_at)


def version_diff(spark, sf_dir):
    return loaded(spark, sf_dir)[0].diff(0, 1, ["o_orderkey"])


def version_diff_appended(spark, sf_dir):
    """Open orders are appended to a table that has them, so their keys repeat."""
    base, changes = base_and_changes(spark, sf_dir)
    orders = SnapshotTable(spark, scratch_path(spark, "orders"))
    orders.write(base)
    orders.write(changes)
    return orders.diff(0, 1, ["o_orderkey"])


def rollback(spark, sf_dir):
    orders, _ = loaded(spark, sf_dir)
    orders.rollback(0)
    return orders.read()


def schema_evolution(spark, sf_dir):
    """New columns come in by an append; older rows read as NULL there."""
    base, changes = base_and_changes(spark, sf_dir)
    orders = SnapshotTable(spark, scratch_path(spark, "orders"))
    orders.write(base)
    orders.write(changes.withColumn("carrier", F.lit("sea")), merge_schema=True)
    return orders.read()


def schema_overwrite(spark, sf_dir):
    base, changes = base_and_changes(spark, sf_dir)
    orders = SnapshotTable(spark, scratch_path(spark, "orders"))
    orders.write(base)
    slim = changes.select(F.col("o_orderkey").cast("string").alias("order_key"), "o_totalprice")
    orders.write(slim, mode="overwrite", overwrite_schema=True)
    return orders.read()


def registered_versions(spark, sf_dir):
    """A catalog table that follows the versioned table through a commit."""
    base, changes = base_and_changes(spark, sf_dir)
    orders = SnapshotTable(spark, scratch_path(spark, "orders"))
    name = "default.versioned_" + orders.path[-8:]
    orders.upsert(base, ["o_orderkey"], partition_by=["o_orderstatus"])
    orders.register(name)
    orders.upsert(changes, ["o_orderkey"])
    orders.register(name)
    return spark.table(name).drop("_batch")


_TABLES = """WITH o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2))
    AS o_totalprice, o_orderdate, o_orderpriority FROM orders),
base AS (SELECT * FROM o WHERE o_orderstatus IN ('F', 'O')),
changes AS (SELECT * REPLACE (CAST(o_totalprice + 1 AS DECIMAL(18,2)) AS o_totalprice,
    'changed' AS o_orderpriority) FROM o WHERE o_orderstatus IN ('O', 'P'))
"""
UPSERT_SQL = (
    _TABLES
    + """SELECT * FROM changes UNION ALL
  SELECT * FROM base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changes)"""
)
BASE_SQL = _TABLES + "SELECT * FROM base"

ENTRIES = {
    "parquet_scan": (
        parquet_scan,
        """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
           WHERE l_quantity > 25 AND l_returnflag = 'R'""",
    ),
    "csv_round_trip": (csv_round_trip, f"WITH {RAW_ORDERS_SQL} SELECT * FROM raw_orders"),
    "csv_strings": (
        csv_strings,
        f"""WITH {RAW_ORDERS_SQL} SELECT * REPLACE (CAST(quantity AS VARCHAR) AS quantity,
              CAST(unit_price AS VARCHAR) AS unit_price, CAST(order_date AS VARCHAR)
              AS order_date) FROM raw_orders""",
    ),
    "json_round_trip": (json_round_trip, "SELECT * FROM documents"),
    "partitioned_write": (partitioned_write, "SELECT * FROM lineitem"),
    "dynamic_overwrite": (
        dynamic_overwrite,
        """SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE o_totalprice END
           AS o_totalprice) FROM orders""",
    ),
    "merged_schemas": (
        merged_schemas,
        """SELECT * REPLACE (CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END
           AS c_acctbal) FROM customer""",
    ),
    "raw_by_day": (raw_by_day, "SELECT *, CAST(ts AS DATE) AS ingestion_date FROM events"),
    "right_sized_files": (
        right_sized_files,
        "SELECT CAST(40 AS BIGINT) AS n_files, count(*) AS n_rows FROM lineitem",
    ),
    "registered_table": (registered_table, "SELECT * FROM orders"),
    "upsert": (upsert, UPSERT_SQL),
    "upsert_replayed": (upsert_replayed, UPSERT_SQL),
    "upsert_partitioned": (upsert_partitioned, UPSERT_SQL),
    "upsert_columns": (
        upsert_columns,
        _TABLES
        + """SELECT b.* REPLACE (coalesce(c.o_orderpriority, b.o_orderpriority)
               AS o_orderpriority)
             FROM base b LEFT JOIN changes c ON b.o_orderkey = c.o_orderkey
             UNION ALL
             SELECT * FROM changes WHERE o_orderkey NOT IN (SELECT o_orderkey FROM base)""",
    ),
    "upsert_delete": (
        upsert_delete,
        _TABLES
        + """SELECT * FROM base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changes)
             UNION ALL
             SELECT c.* FROM changes c LEFT JOIN base b ON b.o_orderkey = c.o_orderkey
             WHERE b.o_orderkey IS NULL OR NOT (c.o_totalprice > 300000 AND b.o_custkey > 10)""",
    ),
    "upsert_null_keys": (
        upsert_null_keys,
        f"""WITH {RAW_ORDERS_SQL}, one AS (
              SELECT customer_id, order_id, max(order_date) AS order_date FROM raw_orders
              GROUP BY ALL)
            SELECT * FROM one
            UNION ALL
            SELECT * FROM one WHERE customer_id IS NULL OR order_id IS NULL""",
    ),
    "append_versions": (
        append_versions,
        _TABLES + "SELECT * FROM base UNION ALL SELECT * FROM changes",
    ),
    "time_travel": (time_travel, BASE_SQL),
    "time_travel_timestamp": (time_travel_timestamp, BASE_SQL),
    "version_diff": (
        version_diff,
        _TABLES
        + """SELECT coalesce(b.o_orderkey, c.o_orderkey) AS o_orderkey,
               CASE WHEN b.o_orderkey IS NULL THEN 'added' ELSE 'changed' END AS change
             FROM base b FULL JOIN changes c ON b.o_orderkey = c.o_orderkey
             WHERE c.o_orderkey IS NOT NULL""",
    ),
    "version_diff_appended": (
        version_diff_appended,
        _TABLES
        + """SELECT o_orderkey,
               CASE WHEN o_orderkey IN (SELECT o_orderkey FROM base) THEN 'changed'
                 ELSE 'added' END AS change FROM changes""",
    ),
    "rollback": (rollback, BASE_SQL),
    "schema_evolution": (
        schema_evolution,
        _TABLES
        + """SELECT *, CAST(NULL AS VARCHAR) AS carrier FROM base
             UNION ALL SELECT *, 'sea' AS carrier FROM changes""",
    ),
    "schema_overwrite": (
        schema_overwrite,
        _TABLES
        + "SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_totalprice FROM changes",
    ),
    "registered_versions": (registered_versions, UPSERT_SQL),
}
ENTRIES |= {
    "upsert_text_keys": (upsert_text_keys, ENTRIES["upsert_columns"][1]),
    "upsert_text_keys_delete": (upsert_text_keys_delete, ENTRIES["upsert_delete"][1]),
}
ENTRIES |= {
    "upsert_text_pruned": (
        upsert_text_pruned,
        _TABLES
        + """, latest AS (
               SELECT * FROM changes WHERE o_orderdate = (SELECT max(o_orderdate) FROM changes))
             SELECT *, md5(CAST(o_orderkey AS VARCHAR)) AS text_key FROM (
               SELECT * FROM base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM latest)
               UNION ALL SELECT * FROM latest)""",
    )
}
ENTRIES |= {"upsert_bucketed": (upsert_bucketed, ENTRIES["upsert"][1])}
