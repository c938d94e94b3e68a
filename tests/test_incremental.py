"""Buckets, once-only merges, compacted days, split parses and checks that add up."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow import DataQualityChecker, KeepLatest, NotNullCheck, RangeCheck, UniquenessCheck
from oreflow.operators.incremental import IncrementalChecks
from oreflow.operators.quality import AcceptedValuesCheck, ReferentialCheck, RowCountCheck
from oreflow.sources.snapshots import SnapshotTable
from oreflow.streaming import ingest
from oreflow.streaming.compaction import StreamTable

ROWS = [(i, f"ORD-{i}", i % 7) for i in range(500)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def orders(spark, folder):
    table = SnapshotTable(spark, f"{folder}/t")
    table.upsert(spark.createDataFrame(ROWS, "id long, name string, n int"), ["name"], buckets=16)
    return table


def test_one_key_rewrites_one_bucket(spark, orders, rows_of):
    first = orders.snapshot()
    assert len(first.folders) == 16 and first.bucket_by == ["name"]
    orders.upsert(spark.createDataFrame([(3, "ORD-3", 99)], "id int, name string, n long"), ["name"])
    second = orders.snapshot()
    gone = set(first.folders) - set(second.folders)
    new = set(second.folders) - set(first.folders)
    assert len(gone) == 1 and {f.split("/")[-1] for f in new} == {f.split("/")[-1] for f in gone}
    expected = [r if r[0] != 3 else (3, "ORD-3", 99) for r in ROWS]
    assert rows_of(orders.read()) == sorted(expected, key=lambda r: [str(v) for v in r])


def test_a_merge_scans_only_its_keys_buckets(spark, orders):
    source = spark.createDataFrame([("ORD-3",), ("ORD-3",)], "name string")
    current = orders.snapshot()
    found = current.layout.reachable(current.folders, source, ["name"])
    assert len(found) == 1
    text = plan(orders._scan(found, current.schema))
    assert text.count("_bucket=") == 1 or "InMemoryFileIndex(1 paths)" in text


def test_merges_on_other_keys_and_null_keys_use_all_buckets(spark, orders, rows_of):
    current = orders.snapshot()
    source = spark.createDataFrame([(3, None, 1)], "id long, name string, n int")
    assert current.layout.reachable(current.folders, source, ["id"]) == current.folders
    orders.upsert(source, ["id"])
    assert (3, None, 1) in rows_of(orders.read()) and orders.read().count() == 500
    for null_safe, n in ((False, 501), (True, 500)):
        table = SnapshotTable(spark, orders.path + str(null_safe))
        table.upsert(spark.createDataFrame([*ROWS[1:], (0, None, 0)], "id long, name string, n int"), ["name"], buckets=4)
        table.upsert(source, ["name"], null_safe=null_safe)
        assert table.read().count() == n


@pytest.mark.parametrize("options", [{"update_columns": ["n"]}, {"delete_condition": "source.n > 5"}])
def test_partial_merges_keep_buckets(spark, orders, options):
    source = spark.createDataFrame([(i, f"ORD-{i}", i) for i in (2, 9, 1000)], "id long, name string, n int")
    orders.upsert(source, ["name"], **options)
    rows = {r["name"]: r["n"] for r in orders.read().collect()}
    assert rows["ORD-2"] == 2 and rows["ORD-1000"] == 1000
    assert rows.get("ORD-9") == (9 if "update_columns" in options else None)
    assert all("_bucket=" in f for f in orders.snapshot().folders)


def test_appends_and_overwrites_take_buckets(spark, folder):
    table, rows = SnapshotTable(spark, folder), spark.createDataFrame(ROWS, "id long, name string, n int")
    with pytest.raises(ValueError, match="go together"):
        table.write(rows, buckets=3)
    table.write(rows, partition_by=["n"], bucket_by=["id"], buckets=3)
    table.write(rows.limit(1))
    assert all(f.count("/") == 2 for f in table.snapshot().folders)
    table.write(rows, "overwrite", overwrite_schema=True)
    assert table.snapshot().buckets == 0 and table.read().count() == 500


def test_a_diff_shuffles_once(spark, orders):
    orders.upsert(spark.createDataFrame([(3, "ORD-3", 99), (900, "ORD-900", 1)], "id long, name string, n int"), ["name"])
    diff = orders.diff(0, 1, ["name"])
    assert sorted(map(tuple, diff.collect())) == [("ORD-3", "changed"), ("ORD-900", "added")]
    assert plan(diff).split("Initial Plan")[-1].count("Exchange") == 1


def test_a_batch_is_merged_once(spark, folder):
    table = SnapshotTable(spark, folder)
    write = ingest.upsert_writer(table, ["k"], KeepLatest(["k"], ["v"]), buckets=2)
    first, second = (spark.createDataFrame([(1, v), (1, v - 1)], "k int, v int") for v in (5, 3))
    for batch, number in ((first, 0), (second, 1), (first, 0), (second, 1)):
        write(batch, number)
    assert [tuple(r) for r in table.read().collect()] == [(1, 3)]
    assert table.versions() == [0, 1] and list(table.snapshot().applied.values()) == [1]
    table.write(first.limit(0))
    assert list(table.snapshot().applied.values()) == [1]


def message(spark, *days):
    rows = [(json.dumps({"order_id": d}).encode(), i, 0, d + " 05:00:00") for i, d in enumerate(days)]
    return spark.createDataFrame(rows, "value binary, offset long, partition int, t string").selectExpr(
        "value", "offset", "partition", "cast(t as timestamp) AS timestamp"
    )


def test_closed_days_are_put_together(spark, folder):
    source, stream = f"{folder}/in", ingest.StreamIngest(f"{folder}/lake", f"{folder}/check", trigger="availableNow", day_of="_ingestion_ts")
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    for _ in range(3):
        message(spark, *days).coalesce(1).write.mode("append").parquet(source)
        stream.start(ingest.file_source(spark, source))
    table = StreamTable(spark, stream.target, spark.read.parquet(stream.target).schema)
    checkpoint = f"{stream.checkpoint}/orders_streaming"
    assert len(table.batches()) == 9 and table.committed(checkpoint)[1] == 2
    assert table.compact(checkpoint, "2024-01-03") == days[:2]
    assert len(table.batches()) == 3 and table.read().count() == 9
    assert table.compact(checkpoint, "2024-01-03") == []
    # A later batch brings a row of a closed day, and is given again.
    message(spark, *days[:1]).write.mode("append").parquet(source)
    stream.start(ingest.file_source(spark, source))
    rows = table.read().groupBy("ingest_date").count().orderBy("ingest_date").collect()
    assert [r["count"] for r in rows] == [4, 3, 3]
    one = table.read().filter("ingest_date = '2024-01-02'")
    assert one.count() == 3 and "PartitionFilters: [isnotnull(ingest_date" in plan(one)
    assert one.select(F.input_file_name()).distinct().count() == 1


def test_uncommitted_batches_are_left(spark, folder):
    write = ingest.batch_writer(folder + "/t", lambda df: df, day_of="timestamp")
    for number in (0, 1, 0):
        write(message(spark, "2024-01-01", "2024-01-02"), number)
    table = StreamTable(spark, folder + "/t", spark.read.parquet(folder + "/t").schema)
    assert table.read().count() == 4
    for name, text in (("metadata", '{"id":"None"}'), ("commits/0", "")):
        ingest_path = f"{folder}/check/{name}"
        spark.createDataFrame([], "a int")  # the session is up
        from oreflow.sources.paths import create_text

        create_text(spark, ingest_path, text)
    assert table.compact(f"{folder}/check", "2025-01-01") == []


def test_rejects_are_told_apart(spark, folder):
    texts = [b'{"order_id": "a", "quantity": 1}', b"{cut", None, b'{"quantity": "x"}', b"[1]", b"{}"]
    rows = [(t, i, 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "value binary, offset long, partition int").withColumn("timestamp", F.current_timestamp())
    ingest.write_split(ingest.parse_or_reject(df), folder + "/out")
    good = spark.read.parquet(folder + "/out/rejected=false")
    bad = spark.read.parquet(folder + "/out/rejected=true")
    assert sorted(r["offset"] for r in good.collect()) == [0, 5]
    assert {r["offset"]: r["rejected_text"] for r in bad.collect()} == {1: "{cut", 2: "", 3: '{"quantity": "x"}', 4: "[1]"}
    assert plan(ingest.parse_or_reject(df)).count("from_json") <= 2


def test_rejected_lines(spark, folder):
    spark.createDataFrame([("1,2.5",), ("x,1",), ("3",), ("4,1,9",)], "line string").coalesce(1).write.text(folder + "/in")
    schema = T.StructType().add("a", T.IntegerType()).add("b", T.DoubleType())
    rows = ingest.read_csv_or_reject(spark, folder + "/in", schema, header="false")
    ingest.write_split(rows, folder + "/out")
    found = {r["rejected_text"] for r in spark.read.parquet(folder + "/out/rejected=true").collect()}
    assert found == {"x,1", "3", "4,1,9"}


def suite(spark):
    checker = DataQualityChecker("t")
    known = spark.createDataFrame([(i,) for i in range(5)], "n int")
    checks = [RowCountCheck(min_rows=4), NotNullCheck("name"), UniquenessCheck(["id", "name"]), UniquenessCheck("id")]
    for check in [*checks, RangeCheck("n", 0, 5), AcceptedValuesCheck("name", ["ORD-1"]), ReferentialCheck("n", known, "n")]:
        checker.add_check(check)
    return checker


def test_states_add_up_to_the_whole(spark, folder, rows_of):
    rows = ROWS + [(1, "ORD-1", 3), (2, None, None), (None, None, 9), (None, None, 9)]
    df = spark.createDataFrame(rows, "id long, name string, n int")
    checks = IncrementalChecks(suite(spark), folder)
    for load in ("a", "b", "c", "a"):
        checks.add(df.filter(F.coalesce(F.col("n"), F.lit(0)) % 3 == "abc".index(load)), load)
    assert rows_of(checks.results(spark)) == rows_of(suite(spark).results(df))
    reread = plan(checks.results(spark))
    assert "LocalTableScan" not in reread and "ExistingRDD" not in reread


def test_an_empty_load_counts_nothing(spark, folder, rows_of):
    df = spark.createDataFrame(ROWS, "id long, name string, n int")
    checks = IncrementalChecks(suite(spark), folder)
    checks.add(df, "1")
    checks.add(df.limit(0), "2")
    assert rows_of(checks.results(spark)) == rows_of(suite(spark).results(df))
