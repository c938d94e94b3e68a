"""Messages made from the given orders, parsed in batch and ingested as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.operators.cleaning import KeepLatest, TrimStrings, compose
from oreflow.sources.paths import scratch_path
from oreflow.sources.snapshots import SnapshotTable
from oreflow.streaming.compaction import StreamTable
from oreflow.streaming.ingest import (
    StreamIngest,
    batch_writer,
    file_source,
    parse_messages,
    parse_or_reject,
    read_csv_or_reject,
    upsert_writer,
    write_split,
)
from workload.inputs import table


def messages(spark, sf_dir):
    """One JSON message per order; those of cheap orders are cut off and do not parse."""
    orders = table(spark, sf_dir, "orders")
    payload = F.to_json(
        F.struct(
            F.concat(F.lit("ORD-"), "o_orderkey").alias("order_id"),
            F.concat(F.lit("CUST-"), "o_custkey").alias("customer_id"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("quantity"),
            F.col("o_totalprice").cast("decimal(18,4)").alias("unit_price"),
            F.when(F.col("o_orderstatus") != "P", F.concat(F.lit(" "), "o_orderstatus")).alias(
                "status"
            ),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        )
    )
    text = F.when(F.col("o_totalprice") < 20000, "{cut off").otherwise(payload)
    return orders.select(
        text.cast("binary").alias("value"),
        F.col("o_orderkey").alias("offset"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("partition"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
    )


def plain(df):
    """Without the session's time zone and the time of the run."""
    stamps = {c: F.col(c).cast("timestamp_ntz") for c in ("kafka_ts", "_ingestion_ts")}
    return df.withColumns(stamps).drop(
        "_processing_ts", "stream_id", "batch_id", "ingest_date"
    )


def parsed(spark, sf_dir):
    return plain(parse_messages(messages(spark, sf_dir)))


def stream_ingest(spark, sf_dir):
    """Two runs of a query on one checkpoint; the second finds nothing new."""
    source, lake = scratch_path(spark, "messages"), scratch_path(spark, "lake")
    messages(spark, sf_dir).repartition(4).write.parquet(source)
    ingest = StreamIngest(lake, f"{lake}/checkpoints", trigger="availableNow")
    for _ in range(2):
        ingest.start(file_source(spark, source, max_files_per_trigger=2))
    return plain(spark.read.parquet(ingest.target))


def stream_replayed(spark, sf_dir):
    """Two batches, the first written again under its number, as after a failure."""
    target = scratch_path(spark, "lake")
    rows = parse_messages(messages(spark, sf_dir))
    write = batch_writer(target, TrimStrings())
    for batch_id in (0, 1, 0):
        write(rows.filter(F.col("offset") % 2 == batch_id), batch_id)
    return plain(spark.read.parquet(target))


def stream_compacted(spark, sf_dir):
    """Batches of all days; those before 1995 are put together before the last batches come."""
    source, lake = scratch_path(spark, "messages"), scratch_path(spark, "lake")
    months = messages(spark, sf_dir).withColumn(
        "timestamp", F.date_trunc("year", "timestamp").cast("timestamp")
    )
    ingest = StreamIngest(
        lake, f"{lake}/checkpoints", trigger="availableNow", day_of="_ingestion_ts"
    )
    for part in range(2):
        months.filter(F.col("offset") % 2 == part).repartition(4).write.mode("append").parquet(source)
        ingest.start(file_source(spark, source, max_files_per_trigger=2))
        written = StreamTable(spark, ingest.target, spark.read.parquet(ingest.target).schema)
        if part == 0:
            written.compact(f"{ingest.checkpoint}/orders_streaming", "1995-01-01")
    return plain(written.read())


def stream_upsert(spark, sf_dir):
    """The latest state of each order and its customer; the first batch comes a second time."""
    table_ = SnapshotTable(spark, scratch_path(spark, "orders"))
    latest = compose(TrimStrings(), KeepLatest(["customer_id"], ["kafka_ts", "offset"]))
    write = upsert_writer(table_, ["customer_id"], latest, buckets=8)
    rows = parse_messages(messages(spark, sf_dir)).filter("customer_id IS NOT NULL")
    for batch_id in (0, 1, 0):
        write(rows.filter(F.col("offset") % 2 == batch_id), batch_id)
    return table_.read().select("customer_id", "order_id", "status", "offset")


def split(spark, path, *columns):
    """What ``write_split`` has written; folder names have no booleans."""
    rejected = F.col("rejected").cast("boolean").alias("rejected")
    return spark.read.parquet(path).select(*columns, rejected, "rejected_text")


def parse_rejected(spark, sf_dir):
    """Good messages and cut-off ones, parsed once and written to two folders."""
    path = scratch_path(spark, "messages")
    write_split(parse_or_reject(messages(spark, sf_dir)), path)
    return split(spark, path, "offset", "order_id")


def csv_rejected(spark, sf_dir):
    """Lines whose price is no number go to a folder of their own."""
    lines, path = scratch_path(spark, "lines"), scratch_path(spark, "orders")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_totalprice") >= 20000, price).otherwise("n/a"), "o_orderstatus"
    ).write.option("header", "true").csv(lines)
    schema = T.StructType().add("key", "long").add("price", "decimal(18,2)").add("status", "string")
    write_split(read_csv_or_reject(spark, lines, schema), path)
    return split(spark, path, "key", "price")


_FIELDS = """CASE WHEN ok THEN 'ORD-' || o_orderkey END AS order_id,
  CASE WHEN ok THEN 'CUST-' || o_custkey END AS customer_id,
  CAST(NULL AS VARCHAR) AS product_id,
  CASE WHEN ok THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS quantity,
  CASE WHEN ok THEN CAST(o_totalprice AS DECIMAL(18,4)) END AS unit_price,
  CASE WHEN ok THEN CAST(o_orderdate AS DATE) END AS order_date,
  CAST(NULL AS VARCHAR) AS channel, o_orderkey AS "offset",
  CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS "partition",
  o_orderdate AS kafka_ts, o_orderdate AS _ingestion_ts"""
_YEAR = "date_trunc('year', o_orderdate)::TIMESTAMP"
_BY_YEAR = _FIELDS.replace("o_orderdate AS kafka_ts", f"{_YEAR} AS kafka_ts").replace(
    "o_orderdate AS _ingestion_ts", f"{_YEAR} AS _ingestion_ts"
)
_FROM = "FROM (SELECT *, o_totalprice >= 20000 AS ok FROM orders)"

ENTRIES = {
    "parse_messages": (
        parsed,
        f"""SELECT {_FIELDS},
              CASE WHEN ok AND o_orderstatus <> 'P' THEN ' ' || o_orderstatus END AS status
            {_FROM}""",
    ),
    "stream_ingest": (
        stream_ingest,
        f"""SELECT {_FIELDS},
              CASE WHEN ok AND o_orderstatus <> 'P' THEN o_orderstatus END AS status,
              'orders_streaming' AS _pipeline_name, 'dev' AS _env {_FROM}""",
    ),
    "stream_replayed": (
        stream_replayed,
        f"""SELECT {_FIELDS},
              CASE WHEN ok AND o_orderstatus <> 'P' THEN o_orderstatus END AS status {_FROM}""",
    ),
    "stream_compacted": (
        stream_compacted,
        f"""SELECT {_BY_YEAR},
              CASE WHEN ok AND o_orderstatus <> 'P' THEN o_orderstatus END AS status,
              'orders_streaming' AS _pipeline_name, 'dev' AS _env {_FROM}""",
    ),
    "stream_upsert": (
        stream_upsert,
        f"""SELECT 'CUST-' || o_custkey AS customer_id, 'ORD-' || o_orderkey AS order_id,
              CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status, o_orderkey AS "offset"
            {_FROM} WHERE ok QUALIFY row_number() OVER (PARTITION BY o_custkey
              ORDER BY o_orderkey % 2 DESC, o_orderdate DESC, o_orderkey DESC) = 1""",
    ),
    "parse_rejected": (
        parse_rejected,
        f"""SELECT o_orderkey AS "offset", CASE WHEN ok THEN 'ORD-' || o_orderkey END AS order_id,
              NOT ok AS rejected, CASE WHEN NOT ok THEN '{{cut off' END AS rejected_text {_FROM}""",
    ),
    "csv_rejected": (
        csv_rejected,
        f"""SELECT o_orderkey AS key, CASE WHEN ok THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS price,
              NOT ok AS rejected,
              CASE WHEN NOT ok THEN o_orderkey || ',n/a,' || o_orderstatus END AS rejected_text {_FROM}""",
    ),
}
