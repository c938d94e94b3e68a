import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from oreflow import DataQualityError, SnapshotTable, create_writer
from oreflow.operators.gold import customer_360, daily_sales, dq_trend, gold_kpis, status_summary
from oreflow.plans.flows import (
    clean_customers,
    clean_orders,
    load_customers,
    load_orders,
    metrics_frame,
    orders_checks,
    run_orders,
)
from oreflow.sources.schemas import RAW_ORDERS_SCHEMA, get_schema


def order(order_id, customer="CUST-A", quantity=2, price="19.99", status="DELIVERED", day=15):
    return (order_id, customer, "PROD-X", quantity, Decimal(price), status, datetime.date(2024, 1, day), "ONLINE")


SAMPLE = [
    order("ORD-001"),
    order("ORD-002", "CUST-B", 1, "99.50", "SHIPPED", 16),
    order("ORD-003", "CUST-C", 3, "5.00", "PENDING", 17),
]


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_ORDERS_SCHEMA)


def cleaned(spark, rows):
    return {r["order_id"]: r for r in clean_orders()(raw(spark, rows)).collect()}


def test_silver_adds_total_and_audit_columns(spark):
    rows = cleaned(spark, SAMPLE)
    assert rows["ORD-001"]["total_amount"] == Decimal("39.98")
    assert rows["ORD-001"]["_pipeline_name"] == "orders_etl" and rows["ORD-001"]["_processing_ts"]
    assert clean_orders()(raw(spark, SAMPLE)).columns == get_schema("silver.orders").names


def test_silver_cleans(spark):
    rows = cleaned(
        spark,
        [
            *SAMPLE,
            SAMPLE[0],
            order(None, "CUST-D"),
            order(" ORD-004 ", status="  delivered "),
            order("ORD-005", status=None),
        ],
    )
    assert sorted(rows) == ["ORD-001", "ORD-002", "ORD-003", "ORD-004", "ORD-005"]
    assert rows["ORD-004"]["status"] == "DELIVERED" and rows["ORD-005"]["status"] == "UNKNOWN"


def test_latest_row_without_customer_does_not_bring_back_an_older_one(spark):
    assert cleaned(spark, [order("ORD-001", day=1), order("ORD-001", None, day=2)]) == {}


def test_unknown_status_only_warns(spark, folder):
    metrics = load_orders(raw(spark, [*SAMPLE, order("ORD-009", status=None)]), folder + "/silver")
    assert (metrics.dq_checks_passed, metrics.dq_checks_failed) == (5, 1)
    assert (metrics.rows_read, metrics.rows_written, metrics.rows_dropped) == (4, 4, 0)


def test_partitioned_load_counts_every_row(spark, folder):
    rows = [order(f"ORD-{n}", status="SHIPPED" if n % 3 else "PENDING", day=1 + n % 20) for n in range(300)]
    metrics = load_orders(raw(spark, rows).repartition(8), folder + "/silver", partition_by=["status", "order_date"])
    table = SnapshotTable(spark, folder + "/silver")
    assert metrics.rows_written == table.read().count() == 300
    assert len(table.snapshot().folders) == 40
    assert metrics.to_dict()["dq_checks_passed"] == 6


def test_closed_gate_publishes_nothing(spark, folder):
    bad = raw(spark, [order("ORD-001", price="-1.00")])
    with pytest.raises(DataQualityError, match="range:unit_price"):
        load_orders(bad, folder + "/silver", dq_path=folder + "/dq")
    assert not SnapshotTable(spark, folder + "/silver").exists()
    assert spark.read.parquet(folder + "/dq").filter("status = 'FAIL'").count() == 1
    load_orders(bad, folder + "/silver", fail_on_error=False)
    assert SnapshotTable(spark, folder + "/silver").read().count() == 1


def test_checks_pass_on_clean_data(spark):
    suite = orders_checks()
    assert all(r.passed for r in suite.run(clean_orders()(raw(spark, SAMPLE))))
    assert [r.check_name for r in suite.last_results] == [
        "row_count",
        "not_null:order_id",
        "not_null:customer_id",
        "unique:order_id",
        "range:unit_price",
        "accepted_values:status",
    ]


def test_second_load_updates_and_inserts(spark, folder):
    load_orders(raw(spark, SAMPLE), folder + "/silver", table_name="default.silver_orders_test")
    load_orders(
        raw(spark, [order("ORD-003", "CUST-C", status="RETURNED"), order("ORD-010")]),
        folder + "/silver",
        table_name="default.silver_orders_test",
    )
    table = SnapshotTable(spark, folder + "/silver")
    rows = {r["order_id"]: r["status"] for r in table.read().collect()}
    assert rows == {"ORD-001": "DELIVERED", "ORD-002": "SHIPPED", "ORD-003": "RETURNED", "ORD-010": "DELIVERED"}
    named = spark.sql("SELECT order_id, status FROM default.silver_orders_test").collect()
    assert dict(tuple(r) for r in named) == rows
    spark.sql("DROP TABLE default.silver_orders_test")


def test_whole_flow_twice_gives_the_same_business_rows(spark, folder, rows_of):
    create_writer(spark, "csv").write(raw(spark, [*SAMPLE, SAMPLE[1], order(None)]), folder + "/raw")
    results = []
    for _ in range(2):
        steps = run_orders(spark, folder + "/raw", folder + "/lake")
        silver = SnapshotTable(spark, folder + "/lake/silver/orders_v2").read()
        kpis = spark.read.parquet(folder + "/lake/gold/orders_kpis")
        summary = spark.read.parquet(folder + "/lake/gold/dq_summary")
        results.append([rows_of(d) for d in (silver.drop("_processing_ts"), kpis, summary)])
    assert results[0] == results[1] and len(results[0][0]) == 3
    assert results[0][1] == [("DELIVERED", Decimal("39.98"), 1), ("PENDING", Decimal("15.00"), 1), ("SHIPPED", Decimal("99.50"), 1)]
    frame = {r["job"]: r for r in metrics_frame(spark, steps).collect()}
    assert list(frame) == ["bronze_ingest", "orders_etl", "gold.orders_kpis", "gold.dq_summary"]
    assert frame["orders_etl"]["rows_dropped"] == 2 and frame["orders_etl"]["elapsed_seconds"] > 0
    assert spark.read.parquet(folder + "/lake/gold/dq_results").count() == 12


def test_customers(spark, folder):
    columns = "customer_id string, first_name string, last_name string, email string, phone string, country string, city string, signup_date string, segment string"
    rows = [
        ("C1", " jean", "dupont ", None, None, "fr", None, "2024-01-15", None),
        ("C1", " jean", "dupont ", None, None, "be", None, "2023-01-15", None),
        ("C2", "ann", "lee", None, None, None, None, "soon", None),
        (None, "x", "y", None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, columns)
    out = {r["customer_id"]: r for r in clean_customers()(df).collect()}
    assert (out["C1"]["full_name"], out["C1"]["country_code"]) == ("Jean DUPONT", "FR")
    assert (out["C2"]["country_code"], out["C2"]["signup_date"]) == ("UNKNOWN", None)
    assert clean_customers()(df).columns == get_schema("silver.customers").names
    metrics = load_customers(df, folder + "/silver")
    assert (metrics.rows_written, metrics.dq_checks_passed) == (2, 2)


def test_gold(spark, rows_of):
    silver = clean_orders()(raw(spark, [*SAMPLE, order("ORD-004", "CUST-B", 1, "0.50", "SHIPPED", 20)]))
    assert rows_of(gold_kpis(silver))[-1] == ("SHIPPED", Decimal("100.00"), 2)
    assert rows_of(status_summary(silver)) == [("DELIVERED", 1), ("PENDING", 1), ("SHIPPED", 2)]
    sales = daily_sales(silver)
    assert sales.count() == 4 and sales.columns == get_schema("gold.daily_sales").names
    customers = spark.createDataFrame([("CUST-B", "Ann", "FR"), ("CUST-Z", "Bob", "BE")], "customer_id string, full_name string, country_code string")
    view = customer_360(customers, silver)
    assert view.columns == get_schema("gold.customer_360").names
    assert [f.dataType for f in view.schema] == [f.dataType for f in get_schema("gold.customer_360")]
    assert rows_of(view) == [
        ("CUST-B", "Ann", "FR", 2, Decimal("100.00"), datetime.date(2024, 1, 16), datetime.date(2024, 1, 20)),
        ("CUST-Z", "Bob", "BE", 0, None, None, None),
    ]


def test_kpis_count_ids_only(spark):
    df = spark.createDataFrame([("A", "X", 1.0), (None, "X", 2.0)], "order_id string, status string, total_amount double")
    assert tuple(gold_kpis(df).first()) == ("X", 3.0, 1)


def test_dq_trend(spark, rows_of):
    rows = [("d", "c", 1.0, "2024-01-01T08:00:00+00:00"), ("d", "c", 0.5, "2024-01-01T23:00:00+00:00"), ("d", "c", 0.0, "2024-01-02T00:00:00+00:00")]
    df = spark.createDataFrame(rows, "dataset string, check_name string, pass_rate double, run_ts string")
    out = dq_trend(df).withColumn("run_date", F.col("run_date").cast("string"))
    assert rows_of(out) == [("d", "c", "2024-01-01", 0.75, 2), ("d", "c", "2024-01-02", 0.0, 1)]
