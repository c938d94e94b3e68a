import datetime
import os
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oreflow import SnapshotTable, create_reader, create_writer
from oreflow.sources.merging import lacking, profile_keys
from oreflow.sources.snapshots import MergeConflictError

ORDER = "order_id string, customer_id string, product_id string, quantity long, status string"
FIRST = [("ORD-001", "CUST-1", "PROD-A", 2, "PENDING"), ("ORD-002", "CUST-2", "PROD-B", 1, "SHIPPED")]
SECOND = [("ORD-001", "CUST-1", "PROD-A", 2, "DELIVERED"), ("ORD-003", "CUST-3", "PROD-C", 5, "PENDING")]


def orders(spark, rows):
    return spark.createDataFrame(rows, ORDER)


def kv(spark, rows, extra=""):
    return spark.createDataFrame(rows, "k string, v int" + extra)


@pytest.fixture
def table(spark, folder):
    return SnapshotTable(spark, folder + "/t")


def test_upsert_story(spark, table, rows_of):
    table.upsert(orders(spark, FIRST), ["order_id"])
    assert rows_of(table.read()) == FIRST
    table.upsert(orders(spark, FIRST), ["order_id"])
    assert rows_of(table.read()) == FIRST
    table.upsert(orders(spark, SECOND), ["order_id"])
    assert rows_of(table.read()) == [SECOND[0], FIRST[1], SECOND[1]]
    assert rows_of(table.read(version=0)) == FIRST
    assert table.versions() == [0, 1, 2]


def test_append_doubles(spark, folder):
    writer = create_writer(spark, "delta")
    writer.write(orders(spark, FIRST), folder + "/t")
    writer.write(orders(spark, FIRST), folder + "/t")
    assert create_reader(spark, "delta").read(folder + "/t").count() == 4


def test_append_and_pure_insert_leave_old_folders_alone(spark, table):
    table.write(kv(spark, [("a", 1)]))
    table.write(kv(spark, [("b", 2)]))
    before = table.snapshot().folders
    table.upsert(kv(spark, [("c", 3)]), ["k"])
    after = table.snapshot().folders
    assert set(before) < set(after) and len(after) == 3


def test_upsert_rewrites_only_folders_with_matches(spark, table, rows_of):
    table.write(kv(spark, [("a", 1), ("b", 2)]))
    table.write(kv(spark, [("c", 3), ("d", 4)]))
    first, second = [table.snapshot(0).folders[0], None]
    second = next(f for f in table.snapshot(1).folders if f != first)
    table.upsert(kv(spark, [("c", 30)]), ["k"])
    assert first in table.snapshot().folders and second not in table.snapshot().folders
    assert rows_of(table.read()) == [("a", 1), ("b", 2), ("c", 30), ("d", 4)]


def test_partitioned_upsert_moves_rows_between_partitions(spark, table, rows_of):
    rows = [("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z a:b/c%"), ("d", 4, None)]
    table.write(kv(spark, rows, ", p string"), partition_by=["p"])
    assert len(table.snapshot().folders) == 4
    table.upsert(kv(spark, [("a", 10, "y"), ("c", 30, "z a:b/c%"), ("d", 40, "x")], ", p string"), ["k"])
    assert rows_of(table.read()) == [("a", 10, "y"), ("b", 2, "y"), ("c", 30, "z a:b/c%"), ("d", 40, "x")]


def test_partition_types_survive(spark, table):
    df = spark.createDataFrame([(1, "007", datetime.date(2024, 1, 1))], "n int, code string, day date")
    table.write(df, partition_by=["code", "day"])
    table.upsert(df.withColumn("n", F.lit(1)), ["n"])
    assert table.read().dtypes == df.dtypes and tuple(table.read().first()) == tuple(df.first())


def test_composite_keys(spark, table, rows_of):
    table.upsert(kv(spark, [("a", 1, 1), ("a", 2, 1)], ", x int"), ["k", "v"])
    table.upsert(kv(spark, [("a", 2, 9), ("b", 1, 9)], ", x int"), ["k", "v"])
    assert rows_of(table.read()) == [("a", 1, 1), ("a", 2, 9), ("b", 1, 9)]


def test_null_keys(spark, folder, rows_of):
    one = SnapshotTable(spark, folder + "/plain")
    for _ in range(2):
        one.upsert(kv(spark, [("a", 1), (None, 2)]), ["k"])
    assert rows_of(one.read()) == [(None, 2), (None, 2), ("a", 1)]
    two = SnapshotTable(spark, folder + "/safe")
    for v in (2, 3):
        two.upsert(kv(spark, [("a", 1), (None, v)]), ["k"], null_safe=True)
    assert rows_of(two.read()) == [(None, 3), ("a", 1)]


def test_duplicate_source_keys_are_refused_every_time(spark, table):
    twice = kv(spark, [("a", 1), ("a", 2)])
    with pytest.raises(MergeConflictError, match="'a'"):
        table.upsert(twice, ["k"])
    assert not table.exists()
    table.upsert(kv(spark, [("a", 1)]), ["k"])
    with pytest.raises(MergeConflictError):
        table.upsert(twice, ["k"])
    assert table.versions() == [0]


def test_update_columns(spark, table, rows_of):
    table.upsert(kv(spark, [("a", 1, "x"), ("b", 2, "x")], ", s string"), ["k"])
    table.upsert(kv(spark, [("b", 20, "new"), ("c", 30, "new")], ", s string"), ["k"], update_columns=["s"])
    assert rows_of(table.read()) == [("a", 1, "x"), ("b", 2, "new"), ("c", 30, "new")]
    with pytest.raises(ValueError, match="nope"):
        table.upsert(kv(spark, [("b", 1, "")], ", s string"), ["k"], update_columns=["nope"])


def test_update_to_null(spark, table, rows_of):
    table.upsert(kv(spark, [("a", 1)]), ["k"])
    table.upsert(kv(spark, [("a", None)]), ["k"], update_columns=["v"])
    assert rows_of(table.read()) == [("a", None)]


def test_delete_condition(spark, table, rows_of):
    table.upsert(kv(spark, [("a", 1), ("b", 2), ("c", 3), (None, 4)]), ["k"])
    source = kv(spark, [("a", 10, True), ("b", 20, False), ("c", 30, None), ("d", 40, True)], ", gone boolean")
    table.upsert(source, ["k"], delete_condition="source.gone")
    assert rows_of(table.read()) == [(None, 4), ("b", 20), ("c", 30), ("d", 40)]


def test_source_must_have_all_columns(spark, table):
    table.upsert(kv(spark, [("a", 1)]), ["k"])
    for options in ({}, {"update_columns": ["v"]}):
        with pytest.raises(ValueError, match="lacks"):
            table.upsert(kv(spark, [("a", 1)]).drop("v"), ["k"], **options)


def test_time_travel(spark, table, rows_of):
    for v in (1, 2, 3):
        table.write(kv(spark, [("a", v)]), mode="overwrite")
    times = [table.snapshot(v).committed for v in range(3)]
    assert times == sorted(set(times))
    assert rows_of(table.read(timestamp=times[1])) == [("a", 2)]
    between = times[1] + (times[2] - times[1]) / 2
    assert rows_of(table.read(timestamp=between.isoformat())) == [("a", 2)]
    assert rows_of(table.read(version=0, timestamp=times[2])) == [("a", 1)]
    for moment in (times[0] - datetime.timedelta(seconds=1), times[2] + datetime.timedelta(seconds=1)):
        with pytest.raises(ValueError, match="commit"):
            table.read(timestamp=moment)
    with pytest.raises(ValueError, match="0..2"):
        table.read(version=7)
    with pytest.raises(ValueError, match="not a timestamp"):
        table.read(timestamp="yesterday noon")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        local = times[1] + datetime.timedelta(hours=9)
        assert table.snapshot(timestamp=local.replace(tzinfo=None)).version == 1
        assert table.snapshot(timestamp=times[1].isoformat().replace("+00:00", "Z")).version == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_missing_table(spark, table):
    with pytest.raises(FileNotFoundError):
        table.read()
    assert not table.exists()


def test_diff(spark, table, rows_of):
    table.upsert(kv(spark, [("a", 1), ("b", None), ("c", 3), (None, 7)]), ["k"], null_safe=True)
    table.upsert(kv(spark, [("a", 1), ("b", 2), ("d", 4), (None, 8)]), ["k"], null_safe=True)
    assert rows_of(table.diff(0, 1, ["k"])) == [(None, "changed"), ("b", "changed"), ("d", "added")]
    assert rows_of(table.diff(1, 0, ["k"])) == [(None, "changed"), ("b", "changed"), ("d", "removed")]
    assert table.diff(1, 1, ["k"]).count() == 0


def test_diff_of_repeated_keys(spark, table, rows_of):
    table.write(kv(spark, [("a", 1), ("b", 2), (None, 3), (None, 3)]))
    table.write(kv(spark, [("a", 1), ("c", 4), (None, 5)]))
    assert rows_of(table.diff(0, 1, ["k"])) == [(None, "changed"), ("a", "changed"), ("c", "added")]
    assert rows_of(table.diff(1, 0, ["k"])) == [(None, "changed"), ("a", "changed"), ("c", "removed")]


def test_rollback_copies_nothing(spark, table, rows_of):
    table.upsert(kv(spark, [("a", 1)]), ["k"])
    table.upsert(kv(spark, [("a", 2)]), ["k"])
    folders = sorted(os.listdir(table.path))
    table.rollback(0)
    assert rows_of(table.read()) == [("a", 1)] and rows_of(table.read(version=1)) == [("a", 2)]
    assert sorted(os.listdir(table.path)) == folders and table.versions() == [0, 1, 2]


def test_crash_before_the_marker_changes_nothing(spark, table, rows_of):
    table.upsert(kv(spark, [("a", 1)]), ["k"])
    table.stage(kv(spark, [("a", 99), ("b", 99)]))
    spark.range(5).write.parquet(table.path + "/_batch=bleftover")
    assert rows_of(table.read()) == [("a", 1)]
    table.upsert(kv(spark, [("b", 2)]), ["k"])
    assert rows_of(table.read()) == [("a", 1), ("b", 2)]


def test_a_version_is_written_once(spark, table):
    table.write(kv(spark, [("a", 1)]))
    other = SnapshotTable(spark, table.path)
    stale = table.snapshot()
    other.write(kv(spark, [("b", 2)]))
    with pytest.raises(Exception, match="already exists"):
        table._commit("append", stale.schema, [], stale.folders, stale)


def test_staged_rows_can_be_checked_then_merged(spark, table, rows_of):
    table.upsert(kv(spark, [("a", 1)]), ["k"])
    staged = table.stage(kv(spark, [("a", 2), ("b", 3)]))
    assert staged.df.count() == 2 and rows_of(table.read()) == [("a", 1)]
    table.upsert(staged, ["k"])
    assert rows_of(table.read()) == [("a", 2), ("b", 3)]


def test_modes(spark, table):
    df = kv(spark, [("a", 1)])
    table.write(df, mode="error")
    with pytest.raises(ValueError, match="exists"):
        table.write(df, mode="error")
    assert table.write(df, mode="ignore") is None and table.read().count() == 1
    with pytest.raises(ValueError, match="sideways"):
        table.write(df, mode="sideways")


def test_schema_evolution_and_overwrite(spark, table, rows_of):
    table.write(kv(spark, [("a", 1)]))
    wide = kv(spark, [("b", 2, "x")], ", s string")
    with pytest.raises(ValueError, match="merge_schema"):
        table.write(wide)
    table.write(wide, merge_schema=True)
    assert rows_of(table.read()) == [("a", 1, None), ("b", 2, "x")]
    table.write(kv(spark, [("c", 3)]))
    assert rows_of(table.read()) == [("a", 1, None), ("b", 2, "x"), ("c", 3, None)]
    assert table.read(version=0).columns == ["k", "v"]
    table.upsert(kv(spark, [("a", 9, "y", 1.5)], ", s string, w double"), ["k"], merge_schema=True)
    assert rows_of(table.read()) == [("a", 9, "y", 1.5), ("b", 2, "x", None), ("c", 3, None, None)]
    table.write(spark.range(2), mode="overwrite", overwrite_schema=True)
    assert table.read().columns == ["id"] and table.read(version=0).columns == ["k", "v"]


def test_empty_write(spark, table):
    table.write(kv(spark, []), partition_by=["v"])
    assert table.read().count() == 0 and table.read().columns == ["k", "v"]
    table.upsert(kv(spark, [("a", 1)]), ["k"])
    assert table.read().count() == 1


def test_register_follows_commits(spark, table, rows_of):
    table.upsert(kv(spark, [("a", 1, "it's"), ("b", 2, "y"), ("c", 3, None)], ", p string"), ["k"], partition_by=["p"])
    table.register("default.follows")
    table.register("default.follows")
    columns = ["k", "v", "p"]
    assert rows_of(spark.table("default.follows").select(columns)) == rows_of(table.read())
    table.upsert(kv(spark, [("a", 10, "y")], ", p string"), ["k"])
    table.register("default.follows")
    assert rows_of(spark.table("default.follows").select(columns)) == [("a", 10, "y"), ("b", 2, "y"), ("c", 3, None)]
    spark.sql("DROP TABLE default.follows")


ROWS = st.dictionaries(st.one_of(st.none(), st.sampled_from("abcdef")), st.integers(0, 3), max_size=6)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    batches=st.lists(ROWS, min_size=1, max_size=3),
    parts=st.booleans(),
    columns=st.booleans(),
    large=st.booleans(),
)
def test_any_sequence_of_upserts_is_a_dict_update(spark, batches, parts, columns, large):
    """Against a plain dict, NULL being a key (null_safe), with and without broadcasts."""
    table, model = SnapshotTable(spark, tempfile.mkdtemp(prefix="run-") + "/t"), {}
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    if large:
        spark.conf.set(threshold, "-1")
    try:
        for batch in batches:
            rows = [(k, v, str(v % 2)) for k, v in batch.items()]
            table.upsert(
                spark.createDataFrame(rows, "k string, v int, p string"),
                ["k"],
                update_columns=["v", "p"] if columns else None,
                null_safe=True,
                partition_by=["p"] if parts else None,
            )
            model.update(batch)
            got = [(r["k"], r["v"]) for r in table.read().collect()]
            assert dict(got) == model and len(got) == len(model)
    finally:
        spark.conf.unset(threshold)


def test_small_source_leaves_the_table_unshuffled(spark, table):
    table.write(kv(spark, [("a", 1), ("b", 2)]))
    source = F.broadcast(kv(spark, [("b", 3)]).select("k"))
    text = lacking(table.read(), source, ["k"], False)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_identical_loads_leave_one_live_folder(spark, table):
    rows = spark.range(100).selectExpr("id as k", "id * 2 as v")
    for _ in range(5):
        last = table.upsert(rows, ["k"])
    assert len(last.folders) == 1 and table.read().count() == 100


@pytest.mark.parametrize("kinds", ["bigint string", "string bigint", "int bigint", "date string"])
@pytest.mark.parametrize("options", [{}, {"update_columns": ["v"]}])
def test_source_keys_of_another_type(spark, table, kinds, options):
    """Text sorts '10' before '9': the key range is that of the table's type."""
    target, source = kinds.split()
    first = ["2024-01-09", "2024-01-10"] if target == "date" else ["9", "10", "50"]
    frame = spark.createDataFrame([(k, "A") for k in first], "k string, v string")
    table.upsert(frame.selectExpr(f"cast(k as {target}) k", "v"), ["k"])
    new = spark.createDataFrame([(k, "b") for k in first[:2]], "k string, v string")
    table.upsert(new.selectExpr(f"cast(k as {source}) k", "v"), ["k"], **options)
    got = sorted((str(r["k"]), r["v"]) for r in table.read().collect())
    assert got == sorted([(k, "b") for k in first[:2]] + [(k, "A") for k in first[2:]])


@pytest.mark.parametrize("name", ["a[1]", "a{1}", "a*b", "a?b", "a b"])
@pytest.mark.parametrize("parts", [None, ["p"]])
def test_odd_paths_lose_nothing(spark, folder, name, parts):
    odd = SnapshotTable(spark, f"{folder}/{name}")
    rows = spark.range(6).selectExpr("id as k", "id % 2 as p")
    odd.write(rows, partition_by=parts)
    odd.upsert(rows.selectExpr("k + 3 as k", "p"), ["k"], update_columns=["p"])
    assert odd.read().count() == 9


def test_key_range_reaches_the_scan(spark, table):
    table.write(kv(spark, [("a", 1), ("b", 2)]))
    profile = profile_keys(kv(spark, [("b", 3), ("d", 4), (None, 5)]), ["k"], False, True)
    assert profile.bounds == {"k": ("b", "d")} and profile.most_rows == 1
    text = table.read().filter(profile.within_bounds(False))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(k,b)" in text and "LessThanOrEqual(k,d)" in text


def test_bloom_filters_of_text_keys_skip_row_groups(spark, table):
    """Hashed keys span the same range in every file; the merge reads the files with its keys."""
    for start in range(0, 8000, 1000):
        keys = spark.range(start, start + 1000).selectExpr("md5(cast(id as string)) k", "id v")
        table.write(keys.coalesce(1), index_by=["k"])
    few = spark.range(3010, 3013).selectExpr("md5(cast(id as string)) k", "-id v")
    profile = profile_keys(few, ["k"], False, True)
    assert len(profile.listed) == 3
    found = table.read().filter(profile.within_bounds(False)).select("k")
    assert len(found.collect()) == 3
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numOutputRows").value() <= 2000
    last = table.upsert(few, ["k"])
    assert len(last.folders) == 9 and last.index_by == ["k"]
    assert sorted(r.v for r in table.read().filter("v < 0").collect()) == [-3012, -3011, -3010]
    assert table.read().count() == 8000


def test_named_keys_of_several_columns(spark, table):
    kind = "a string, b int, v int"
    table.upsert(spark.createDataFrame([("x", 1, 1), ("x", 2, 2), (None, 1, 3)], kind), ["a", "b"])
    new = spark.createDataFrame([("x", 2, 9), (None, 1, 8)], kind)
    table.upsert(new, ["a", "b"], null_safe=True)
    assert sorted(r.v for r in table.read().collect()) == [1, 8, 9]
