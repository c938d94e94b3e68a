import datetime

import pytest
from pyspark.sql import functions as F

from oreflow.streaming.ingest import (
    MESSAGE_SCHEMA,
    StreamIngest,
    batch_writer,
    file_source,
    kafka_source,
    parse_messages,
    trigger_options,
)

STAMP = datetime.datetime(2024, 1, 1, 12)


def messages(spark, payloads, first_offset=0):
    rows = [(bytearray(p, "utf-8"), first_offset + i, 0, STAMP) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def order(n, status=" pending "):
    return f'{{"order_id": " ORD-{n} ", "quantity": {n}, "unit_price": 1.5, "status": "{status}", "order_date": "2024-01-15"}}'


def test_parse_messages(spark):
    out = parse_messages(messages(spark, [order(1), "not json", '{"quantity": "many"}']))
    assert out.columns[:3] == ["offset", "partition", "kafka_ts"] and out.columns[-1] == "_ingestion_ts"
    rows = out.collect()
    assert (rows[0]["order_id"], rows[0]["quantity"], rows[0]["order_date"]) == (" ORD-1 ", 1, datetime.date(2024, 1, 15))
    assert rows[0]["_ingestion_ts"] == rows[0]["kafka_ts"]
    assert rows[1]["order_id"] is None and rows[1]["offset"] == 1
    assert rows[2]["quantity"] is None


def test_trigger_options():
    assert trigger_options("30 seconds") == {"processingTime": "30 seconds"}
    assert trigger_options("once") == trigger_options("availableNow") == {"availableNow": True}


def ingest_of(folder, checkpoint="/cp"):
    return StreamIngest(folder + "/lake", folder + checkpoint, trigger="availableNow")


def test_ingest_resumes_from_its_checkpoint(spark, folder):
    messages(spark, [order(n) for n in range(10)]).repartition(4).write.parquet(folder + "/in")
    ingest = ingest_of(folder)
    ingest.start(file_source(spark, folder + "/in", max_files_per_trigger=1))
    stored = spark.read.parquet(ingest.target)
    assert stored.count() == 10 and stored.select("batch_id").distinct().count() == 4
    row = stored.first()
    assert row["status"] == "pending" and row["_pipeline_name"] == "orders_streaming" and row["_env"] == "dev"
    messages(spark, [order(99)], 10).write.mode("append").parquet(folder + "/in")
    ingest.start(file_source(spark, folder + "/in"))
    stored = spark.read.parquet(ingest.target)
    assert stored.count() == 11 and stored.select("stream_id").distinct().count() == 1


def test_new_checkpoint_does_not_overwrite_old_batches(spark, folder):
    messages(spark, [order(1)]).write.parquet(folder + "/in")
    for checkpoint in ("/one", "/two"):
        ingest_of(folder, checkpoint).start(file_source(spark, folder + "/in"))
    stored = spark.read.parquet(folder + "/lake/bronze/orders")
    assert stored.count() == 2 and stored.select("stream_id").distinct().count() == 2


def test_replayed_batch_replaces_itself(spark, folder):
    write = batch_writer(folder + "/t", lambda df: df)
    for _ in range(2):
        write(spark.range(5), 0)
    write(spark.range(3), 1)
    assert spark.read.parquet(folder + "/t").groupBy("batch_id").count().orderBy("batch_id").collect() == [(0, 5), (1, 3)]


def test_stop(spark, folder):
    messages(spark, [order(1)]).write.parquet(folder + "/in")
    ingest = StreamIngest(folder + "/lake", folder + "/cp", trigger="1 second")
    query = ingest.start(file_source(spark, folder + "/in"), await_termination=False)
    query.processAllAvailable()
    assert query.isActive
    ingest.stop()
    assert not query.isActive and spark.read.parquet(ingest.target).count() == 1


def test_other_datasets(spark, folder):
    schema = parse_messages(messages(spark, [])).select(F.lit(1).alias("n")).schema
    messages(spark, ['{"n": 7}']).write.parquet(folder + "/in")
    ingest = StreamIngest(folder + "/lake", folder + "/cp", "products", schema, "prod", "once")
    ingest.start(file_source(spark, folder + "/in"))
    row = spark.read.parquet(folder + "/lake/bronze/products").first()
    assert (row["n"], row["_pipeline_name"], row["_env"]) == (7, "products_streaming", "prod")


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_source(spark, "localhost:9092", "orders")
