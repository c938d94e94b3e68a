"""A third of the rows, or more, under one key: right results, and no task that holds them."""

import pytest
from pyspark.sql import functions as F

from oreflow import DataQualityChecker, DropDuplicates, KeepLatest, SnapshotTable, UniquenessCheck
from oreflow.operators.gold import customer_360
from oreflow.operators.quality import ReferentialCheck
from oreflow.sources.merging import lacking


def hot(spark, n=30_000):
    """Every second row has the key 0, some have NULL, the rest are spread."""
    return spark.range(n, numPartitions=6).selectExpr(
        "case when id % 2 = 0 then 0 when id % 7 = 0 then null else id end as k",
        "cast(id % 1000 as int) as ts",
        "id as v",
    )


def rows_entering_the_largest_reduce_task(spark, df):
    """Most shuffle records that one task of the query read, from Spark's task metrics."""
    store = spark.sparkContext._jsc.sc().statusStore()
    seen = {s.stageId() for s in _stages(spark, store)}
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # or the few test rows would share one task anyway
    try:
        df.write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.unset(coalesce)
    most = 0
    for stage in _stages(spark, store):
        if stage.stageId() in seen or stage.shuffleReadRecords() == 0:
            continue
        tasks = store.taskList(stage.stageId(), stage.attemptId(), 10_000)
        for i in range(tasks.size()):
            metrics = tasks.apply(i).taskMetrics()
            if metrics.isDefined():
                most = max(most, metrics.get().shuffleReadMetrics().recordsRead())
    return most


def _stages(spark, store):
    jvm = spark._jvm
    empty = jvm.java.util.ArrayList()
    quantiles = spark.sparkContext._gateway.new_array(jvm.double, 0)
    stages = store.stageList(empty, False, False, quantiles, empty)
    return [stages.apply(i) for i in range(stages.size())]


def test_keep_latest(spark):
    df = hot(spark)
    out = KeepLatest(["k"], ["ts"])(df)
    expected = df.groupBy("k").agg(F.max(F.struct("ts", "v")).alias("m")).select("k", "m.ts", "m.v")
    assert out.exceptAll(expected).count() == 0 and out.count() == expected.count()
    assert rows_entering_the_largest_reduce_task(spark, out) < 5_000


def test_drop_duplicates(spark):
    out = DropDuplicates(["k"])(hot(spark))
    assert out.count() == hot(spark).select("k").distinct().count()
    assert rows_entering_the_largest_reduce_task(spark, out) < 5_000


def test_uniqueness_and_references(spark):
    df = hot(spark)
    parent = spark.range(0, 30_000, 2).toDF("id")
    suite = DataQualityChecker("hot").add_check(UniquenessCheck("k"))
    suite.add_check(ReferentialCheck("k", parent, "id"))
    unique, referential = suite.run(df)
    assert unique.failing_rows == df.count() - df.select("k").distinct().count()
    assert referential.failing_rows == df.filter("k is not null and k % 2 = 1").count()
    assert rows_entering_the_largest_reduce_task(spark, suite.results(df)) < 10_000


def test_customer_360(spark):
    orders = hot(spark).selectExpr(
        "cast(k as string) as customer_id",
        "cast(v as decimal(32,2)) as total_amount",
        "date_add(date'2024-01-01', ts) as order_date",
    )
    customers = spark.range(100).selectExpr("cast(id as string) as customer_id")
    view = customer_360(customers, orders)
    row = view.filter("customer_id = '0'").first()
    assert row["nb_orders"] == 15_000 and view.count() == 100


@pytest.mark.parametrize("options", [{}, {"update_columns": ["v"]}, {"delete_condition": "source.v < 0"}])
def test_upsert_into_a_table_with_many_null_keys(spark, folder, options):
    """Rows with a NULL key are kept, and the join does not bring them together."""
    table = SnapshotTable(spark, folder + "/t")
    rows = hot(spark).dropDuplicates(["k"]).filter("k is not null")
    nulls = hot(spark).withColumn("k", F.lit(None).cast("long"))
    table.write(rows.unionByName(nulls).repartition(6))
    source = spark.range(50).selectExpr("id as k", "-1 as ts", "id + 1 as v")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = lacking(table.read(), source, ["k"], null_safe=False)
        assert rows_entering_the_largest_reduce_task(spark, kept) < 15_000
        table.upsert(source, ["k"], **options)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    out = table.read()
    assert out.filter("k is null").count() == 30_000
    assert out.filter("k is not null").count() == rows.join(source, "k", "full").count()
