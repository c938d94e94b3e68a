import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow import (
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
    Transformer,
    TrimStrings,
    compose,
)


def values(df, column):
    return [row[column] for row in df.collect()]


def test_trim_strips_spaces_only_by_default(spark):
    df = spark.createDataFrame([("  hello  ", 1), ("  world", 2), ("\t a \n", 3), (None, 4)], "name string, n int")
    assert values(TrimStrings()(df), "name") == ["hello", "world", "\t a \n", None]
    assert values(TrimStrings(whitespace="all")(df), "name") == ["hello", "world", "a", None]
    with pytest.raises(ValueError, match="whitespace"):
        TrimStrings(whitespace="some")(df)


def test_trim_keeps_order_types_and_odd_names(spark):
    df = spark.createDataFrame([(1, " x ", " y ")], ["n", "a.b", "c`d"])
    out = TrimStrings()(df)
    assert out.columns == ["n", "a.b", "c`d"] and tuple(out.first()) == (1, "x", "y")


def test_drop_duplicates(spark):
    df = spark.createDataFrame([("A", 1), ("A", 1), ("B", 2)], "id string, val long")
    assert DropDuplicates()(df).count() == 2
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3), (None, 4), (None, 5)], "id string, val long")
    assert sorted(values(DropDuplicates(["id"])(df), "id"), key=str) == ["A", "B", None]


def test_keep_latest_takes_greatest_then_breaks_ties(spark, rows_of):
    df = spark.createDataFrame(
        [("A", 1, "x"), ("A", 3, "p"), ("A", 3, "q"), ("B", None, "z"), ("B", 0, "a"), (None, 1, "n")],
        "id string, ts int, v string",
    )
    out = KeepLatest(["id"], ["ts"])(df)
    assert out.columns == df.columns
    assert rows_of(out) == [(None, 1, "n"), ("A", 3, "q"), ("B", 0, "a")]


def test_keep_latest_does_not_depend_on_partitioning(spark, rows_of):
    df = spark.range(3000).selectExpr("id % 7 as k", "cast(id % 11 as int) as ts", "id * 31 % 1000 as v")
    keep = KeepLatest(["k"], ["ts"])
    assert rows_of(keep(df.repartition(1))) == rows_of(keep(df.repartition(13, "v")))


def test_drop_null_keys(spark):
    df = spark.createDataFrame([("A", "X"), (None, "Y"), ("C", None), ("", "")], "id string, name string")
    assert DropNullKeys(["id"])(df).count() == 3
    assert DropNullKeys(["id", "name"])(df).count() == 2
    assert DropNullKeys(["absent"])(df).count() == 4
    nan = spark.createDataFrame([(float("nan"),), (None,)], "x double")
    assert DropNullKeys(["x"])(nan).count() == 1


def test_cast_columns_types_and_bad_input(spark):
    df = spark.createDataFrame(
        [("1", "23.9", "yes", "abc", "2024-01-15"), (" 2 ", "-7.", "NO", "1e3", "nope"), ("x", "99999999999", "", "NaN", None)],
        "q string, cut string, flag string, d string, day string",
    )
    out = CastColumns(
        {"q": "integer", "cut": "int", "flag": "boolean", "d": "double", "day": "date", "absent": "int"}
    )(df)
    assert [f.dataType for f in out.schema] == [T.IntegerType(), T.IntegerType(), T.BooleanType(), T.DoubleType(), T.DateType()]
    rows = [tuple(r) for r in out.collect()]
    assert rows[0] == (1, 23, True, None, datetime.date(2024, 1, 15))
    assert rows[1] == (2, -7, False, 1000.0, None)
    assert rows[2][:3] == (None, None, None) and rows[2][3] != rows[2][3]


@pytest.mark.parametrize("target", ["decimal(18,4)", "float", "double", "long", "boolean", "timestamp"])
def test_lenient_cast_agrees_with_try_cast_on_good_and_bad_text(spark, target):
    texts = ["0", "12", "-3", " 4 ", "+5", "1e2", "", "n/a", "true", "F", "Infinity", "-inf", "2024-01-15 10:00:00", "9" * 30]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    ours = CastColumns({"t": target})(df).select(F.col("t").cast("string")).collect()
    theirs = df.select(F.col("t").try_cast(target).cast("string")).collect()
    assert ours == theirs


def test_cast_raises_on_request(spark):
    df = spark.createDataFrame([("abc",)], "q string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        CastColumns({"q": "int"}, on_error="raise")(df).collect()
    with pytest.raises(ValueError):
        CastColumns({"q": "int"}, on_error="skip")(df)


def test_rename_in_sequence(spark):
    df = spark.createDataFrame([("A", 1)], ["a", "n"])
    assert RenameColumns({"a": "b", "b": "c", "absent": "d"})(df).columns == ["c", "n"]


def test_normalise_strings(spark):
    df = spark.createDataFrame([("jean dupont", "aB", 1)], ["name", "code", "n"])
    assert tuple(NormaliseStrings()(df).first()) == ("JEAN DUPONT", "AB", 1)
    assert tuple(NormaliseStrings(["name"], "title")(df).first()) == ("Jean Dupont", "aB", 1)
    assert tuple(NormaliseStrings(["code", "absent"], "LOWER")(df).first()) == ("jean dupont", "ab", 1)
    with pytest.raises(ValueError, match="upper"):
        NormaliseStrings(case="camel")(df)


def test_derived_columns_build_on_each_other_and_replace(spark):
    df = spark.createDataFrame([(2, 10.0), (3, 5.0)], "qty long, price double")
    out = ComputeDerivedColumns({"total": "qty * price", "twice": "total * 2", "qty": "qty + 1"})(df)
    assert out.columns == ["qty", "price", "total", "twice"]
    assert [tuple(r) for r in out.collect()] == [(3, 10.0, 20.0, 40.0), (4, 5.0, 15.0, 30.0)]


def test_filter_rows_drops_null(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "val long")
    assert values(FilterRows("val > 1")(df), "val") == [2, 3]


def test_audit_columns(spark):
    out = AddAuditColumns("orders_etl")(spark.range(1))
    assert out.columns == ["id", "_processing_ts", "_pipeline_name", "_env"]
    assert out.schema["_processing_ts"].dataType == T.TimestampType()
    row = out.first()
    assert (row["_pipeline_name"], row["_env"]) == ("orders_etl", "dev")


def test_ingestion_columns(spark, folder):
    spark.range(3).coalesce(1).write.parquet(folder + "/in")
    rows = AddIngestionColumns()(spark.read.parquet(folder + "/in")).collect()
    assert all(r["_source_file"].endswith(".parquet") and r["_ingestion_ts"] for r in rows)


def test_enforce_schema(spark):
    schema = T.StructType([T.StructField("b", T.DecimalType(18, 4)), T.StructField("a", T.IntegerType()), T.StructField("z", T.StringType())])
    df = spark.createDataFrame([("1", "2.5", "extra")], ["a", "b", "c"])
    with pytest.raises(ValueError, match="z"):
        EnforceSchema(schema)(df)
    out = EnforceSchema(schema, strict=False)(df)
    assert out.columns == ["b", "a"] and tuple(out.first()) == (Decimal("2.5000"), 1)


def test_mask_pii(spark):
    df = spark.createDataFrame([("alice@example.com", 7), (None, 7)], "email string, id int")
    out = MaskPiiColumns(["email", "absent"], "test-salt")(df).collect()
    again = MaskPiiColumns(["email"], "test-salt")(df).collect()
    other = MaskPiiColumns(["email"], "other")(df).collect()
    assert len(out[0]["email"]) == 64 and out[0]["email"] != "alice@example.com"
    assert out == again and out[0]["email"] != other[0]["email"]
    assert out[1]["email"] is None
    assert "test-salt" not in repr(MaskPiiColumns(["email"], "test-salt"))


def test_compose_nests_and_defaults_to_identity(spark):
    df = spark.createDataFrame([(" a ", 1), (None, 2)], "s string, n int")
    clean = compose(TrimStrings(), DropNullKeys(["s"]))
    both = compose(clean, compose(), lambda d: d.withColumn("m", F.col("n") + 1))
    assert [tuple(r) for r in both(df).collect()] == [("a", 1, 2)]
    assert compose()(df) is df


def test_own_transformer(spark):
    class Double(Transformer):
        def transform(self, df):
            return df.withColumn("id", F.col("id") * 2)

    assert values(compose(Double(), Double())(spark.range(2)), "id") == [0, 4]
    with pytest.raises(NotImplementedError):
        Transformer()(spark.range(1))


def test_total_amount_is_rounded_decimal(spark):
    df = spark.createDataFrame([(2, Decimal("19.99"))], "quantity int, unit_price decimal(18,4)")
    out = ComputeDerivedColumns({"total_amount": "round(cast(quantity as decimal(18,4)) * unit_price, 2)"})(df)
    assert out.schema["total_amount"].dataType == T.DecimalType(32, 2)
    assert out.first()["total_amount"] == Decimal("39.98")
