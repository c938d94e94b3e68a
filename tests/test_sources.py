import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from oreflow import create_reader, create_writer, get_schema
from oreflow.functions.layout import repartition_by_size
from oreflow.sources.paths import scratch_path, zone_path
from oreflow.sources.readers import jdbc_options
from oreflow.sources.schemas import RAW_ORDERS_SCHEMA, SCHEMA_REGISTRY
from oreflow.sources.writers import register_table, write_raw

ORDERS = [
    ("ORD-001", "CUST-A", "PROD-X", 2, Decimal("19.9900"), "DELIVERED", datetime.date(2024, 1, 15), "ONLINE"),
    ("ORD-002", None, "PROD-Y", 1, Decimal("99.5000"), " SHIPPED ", datetime.date(2024, 1, 16), 'a "b", c'),
]


def write_text(folder, name, text):
    with open(f"{folder}/{name}", "w", encoding="utf-8") as out:
        out.write(text)
    return f"{folder}/{name}"


def test_parquet_modes_and_partitions(spark, folder, rows_of):
    writer, reader = create_writer(spark, "PARQUET"), create_reader(spark, "Parquet")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string")
    writer.write(df, folder + "/t", partition_by=["p"])
    writer.write(df, folder + "/t", mode="append", partition_by=["p"])
    writer.write(df, folder + "/t", mode="ignore", partition_by=["p"])
    assert rows_of(reader.read(folder + "/t")) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writer.write(df, folder + "/t", mode="error")
    writer.write(df.filter("n = 1"), folder + "/t")
    assert reader.read(folder + "/t", schema="n long").collect()[0][0] == 1


def test_merge_schema(spark, folder):
    spark.range(1).write.parquet(folder + "/t")
    spark.range(1).withColumn("x", F.lit(1)).write.mode("append").parquet(folder + "/t")
    read = create_reader(spark, "parquet").read(folder + "/t", merge_schema=True)
    assert set(read.columns) == {"id", "x"}


def test_dynamic_overwrite_replaces_touched_partitions_only(spark, folder, rows_of):
    writer = create_writer(spark, "parquet")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string")
    writer.write(df, folder + "/t", partition_by=["p"])
    new = spark.createDataFrame([(9, "b")], "n int, p string")
    writer.write(new, folder + "/t", partition_by=["p"], dynamic_overwrite=True, rebalanced=True)
    assert rows_of(spark.read.parquet(folder + "/t")) == [(1, "a"), (9, "b")]


def test_rebalanced_write_makes_few_files(spark, folder):
    df = spark.range(4000, numPartitions=8).withColumn("p", F.col("id") % 3)
    create_writer(spark, "parquet").write(df, folder + "/t", partition_by=["p"], rebalanced=True)
    files = spark.read.parquet(folder + "/t").select("_metadata.file_path").distinct().count()
    assert files == 3


def test_csv_defaults(spark, folder):
    path = write_text(folder, "in.csv", "n,d,ts,s\n1,2024-01-15,2024-01-15 10:00:00,\"\"\nx,bad,,  \n2,2024-01-16,,é,extra\n")
    reader = create_reader(spark, "csv")
    assert [t for _, t in reader.read(path).dtypes] == ["string"] * 4
    rows = reader.read(path, schema="n int, d date, ts timestamp_ntz, s string").collect()
    assert tuple(rows[0]) == (1, datetime.date(2024, 1, 15), datetime.datetime(2024, 1, 15, 10), None)
    assert tuple(rows[1]) == (None, None, None, "  ")
    assert tuple(rows[2]) == (2, datetime.date(2024, 1, 16), None, "é")


def test_csv_options_override(spark, folder):
    path = write_text(folder, "in.csv", "1;15/01/2024\n")
    read = create_reader(spark, "csv").read(path, schema="n int, d date", sep=";", header="false", dateFormat="dd/MM/yyyy")
    assert tuple(read.first()) == (1, datetime.date(2024, 1, 15))


def test_csv_round_trip_keeps_padding_nulls_and_quotes(spark, folder, rows_of):
    df = spark.createDataFrame(ORDERS, RAW_ORDERS_SCHEMA)
    create_writer(spark, "csv").write(df, folder + "/t")
    assert rows_of(create_reader(spark, "csv").read(folder + "/t", schema=RAW_ORDERS_SCHEMA)) == ORDERS


def test_json_lines_and_multiline(spark, folder):
    lines = write_text(folder, "a.json", '{"n": 1}\n{"n": 2}\n')
    whole = write_text(folder, "b.json", '[\n{"n": 1},\n{"n": 2}\n]')
    reader = create_reader(spark, "json")
    assert [r.n for r in reader.read(lines, schema="n int").collect()] == [1, 2]
    assert [r.n for r in reader.read(whole, multiline=True).collect()] == [1, 2]


def test_factories(spark):
    with pytest.raises(ValueError, match="parquet"):
        create_reader(spark, "xml")
    with pytest.raises(ValueError, match="parquet"):
        create_writer(spark, "xml")


def test_jdbc_options():
    """Options only: opening a connection needs a database."""
    plain = jdbc_options("jdbc:x", "orders", "u", "p")
    assert plain == {"url": "jdbc:x", "dbtable": "orders", "user": "u", "password": "p"}
    split = jdbc_options("jdbc:x", "orders", None, None, "id", 1, 100, 10)
    assert split == {"url": "jdbc:x", "dbtable": "orders", "partitionColumn": "id", "lowerBound": 1, "upperBound": 100, "numPartitions": 10}
    with pytest.raises(ValueError, match="lowerBound, upperBound"):
        jdbc_options("jdbc:x", "orders", partition_column="id", num_partitions=4)


def test_schemas():
    assert get_schema("raw.orders") is RAW_ORDERS_SCHEMA
    assert RAW_ORDERS_SCHEMA.simpleString() == (
        "struct<order_id:string,customer_id:string,product_id:string,quantity:int,"
        "unit_price:decimal(18,4),status:string,order_date:date,channel:string>"
    )
    assert all(f.nullable for f in RAW_ORDERS_SCHEMA)
    assert not get_schema("silver.orders")["order_id"].nullable
    with pytest.raises(KeyError, match="silver.customers"):
        get_schema("unknown")
    for name, schema in SCHEMA_REGISTRY.items():
        stamp = {"raw": "_ingestion_ts", "silver": "_processing_ts"}.get(name.split(".")[0])
        assert stamp is None or stamp in schema.names or name == "raw.orders"


def test_repartition_by_size(spark):
    df = spark.range(100)
    assert repartition_by_size(df, 128, 5120).rdd.getNumPartitions() == 40
    assert repartition_by_size(df, 128, 129).rdd.getNumPartitions() == 2
    assert repartition_by_size(df, 128, 1).rdd.getNumPartitions() == 1


def test_register_table_is_idempotent(spark, folder):
    spark.range(3).write.parquet(folder + "/t")
    for _ in range(2):
        register_table(spark, "default.registered_once", folder + "/t")
    assert create_reader(spark, "table").read("default.registered_once").count() == 3
    spark.sql("DROP TABLE default.registered_once")
    assert spark.read.parquet(folder + "/t").count() == 3


def test_raw_zone_by_day(spark, folder):
    df = spark.createDataFrame(
        [(1, datetime.datetime(2024, 1, 1, 23)), (2, datetime.datetime(2024, 1, 2, 1))], "n int, _ingestion_ts timestamp_ntz"
    ).withColumn("_ingestion_ts", F.col("_ingestion_ts").cast("timestamp"))
    write_raw(df, folder + "/raw")
    days = spark.read.parquet(folder + "/raw").select("n", F.col("ingestion_date").cast("string")).collect()
    assert sorted(tuple(r) for r in days) == [(1, "2024-01-01"), (2, "2024-01-02")]


def test_paths(spark):
    assert zone_path("s3a://lake/", "silver", "orders", "") == "s3a://lake/silver/orders"
    assert zone_path("/lake", "other") == "/lake/other"
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
