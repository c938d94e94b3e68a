import datetime
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from oreflow import (
    AcceptedValuesCheck,
    CheckResult,
    DataQualityChecker,
    DataQualityError,
    NotNullCheck,
    RangeCheck,
    RegexCheck,
    RowCountCheck,
    Severity,
    UniquenessCheck,
)
from oreflow.operators.quality import RESULT_SCHEMA, BaseCheck, ReferentialCheck, summarise


def one(df, check):
    return check.run(df, "test")


def frame(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_not_null(spark):
    result = one(frame(spark, ["A", None]), NotNullCheck("x"))
    assert (result.status, result.total_rows, result.failing_rows, result.passing_rows) == ("FAIL", 2, 1, 1)
    assert result.pass_rate == 0.5 and not result.passed
    assert result.details == {"column": "x", "null_rate": 0.5, "threshold": 0.0}
    assert one(frame(spark, ["A", None, "C", "D"]), NotNullCheck("x", threshold=0.30)).passed
    warned = one(frame(spark, [None]), NotNullCheck("x", severity=Severity.WARN))
    assert warned.status == "WARN" and warned.severity is Severity.WARN


def test_uniqueness(spark):
    result = one(frame(spark, ["A", "A", "B"]), UniquenessCheck("x"))
    assert (result.status, result.failing_rows, result.passing_rows) == ("FAIL", 1, 2)
    pairs = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1)], "id string, sub_id long")
    assert one(pairs, UniquenessCheck(["id", "sub_id"])).passed
    assert one(frame(spark, ["A", "A", "B"]), UniquenessCheck("x", threshold=0.4)).passed


def test_uniqueness_counts_null_as_a_value(spark):
    result = one(frame(spark, [None, None, "A"]), UniquenessCheck("x"))
    assert (result.total_rows, result.failing_rows, result.passing_rows) == (3, 1, 2)


def test_accepted_values(spark):
    result = one(frame(spark, ["OPEN", "INVALID", None]), AcceptedValuesCheck("x", ["OPEN", "CLOSED"]))
    assert (result.status, result.failing_rows) == ("WARN", 1)
    assert one(frame(spark, ["OPEN", None]), AcceptedValuesCheck("x", ["OPEN"])).passed
    assert one(frame(spark, ["A", None]), AcceptedValuesCheck("x", [])).failing_rows == 2


def test_row_count(spark):
    df = spark.range(100)
    assert one(df, RowCountCheck(1, 100)).passed
    over = one(df, RowCountCheck(max_rows=50))
    assert (over.status, over.failing_rows, over.passing_rows, over.pass_rate) == ("WARN", 1, 0, 0.0)
    assert over.details == {"actual": 100, "min_rows": 1, "max_rows": 50}
    assert one(df.limit(0), RowCountCheck(severity=Severity.FAIL)).status == "FAIL"


def test_range(spark):
    df = frame(spark, [-1, 5, None, 200], "long")
    assert one(df, RangeCheck("x", min_val=0)).failing_rows == 1
    assert one(df, RangeCheck("x", max_val=100)).failing_rows == 1
    assert one(df, RangeCheck("x", -1, 200)).passed
    assert one(df, RangeCheck("x")).passed
    nan = frame(spark, [float("nan")], "double")
    assert one(nan, RangeCheck("x", min_val=0.0)).passed
    assert not one(nan, RangeCheck("x", max_val=10.0)).passed


def test_range_on_text_compares_numbers(spark):
    assert one(frame(spark, ["-1", "5", "abc", None]), RangeCheck("x", min_val=0.0)).failing_rows == 1


def test_regex_is_unanchored_and_skips_null(spark):
    result = one(frame(spark, ["a1", "b", None]), RegexCheck("x", r"\d"))
    assert (result.status, result.failing_rows) == ("FAIL", 1)


def test_referential(spark):
    child = frame(spark, [1, 1, 2, 9, 9, 9, None], "long")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long")
    result = one(child, ReferentialCheck("x", parent, "id"))
    assert (result.total_rows, result.failing_rows, result.status) == (7, 3, "FAIL")


def test_struct_fields_and_other_case(spark):
    df = spark.createDataFrame([(("Paris", 1),), ((None, 1),)], "address struct<city:string,n:int>")
    assert one(df, NotNullCheck("address.city")).failing_rows == 1
    assert one(df, UniquenessCheck(["address.n"])).failing_rows == 1
    assert one(df, RangeCheck("ADDRESS.N", min_val=2)).failing_rows == 2
    assert one(df, RegexCheck("address.city", "^P")).passed
    dotted = spark.createDataFrame([(1,), (None,)], "`a.b` int")
    assert one(dotted, NotNullCheck("a.b")).failing_rows == 1


def test_empty_table_passes_all_but_row_count(spark):
    df = spark.createDataFrame([], "x string, n int")
    suite = DataQualityChecker("empty")
    for check in (
        RowCountCheck(),
        NotNullCheck("x"),
        UniquenessCheck("x"),
        AcceptedValuesCheck("x", ["A"]),
        RangeCheck("n", 0, 1),
        RegexCheck("x", "a"),
    ):
        suite.add_check(check)
    results = suite.run(df)
    assert [r.passed for r in results] == [False, True, True, True, True, True]
    assert all(r.pass_rate == 1.0 for r in results[1:])


def make_suite():
    return (
        DataQualityChecker("orders")
        .add_check(RowCountCheck())
        .add_check(UniquenessCheck("k"))
        .add_check(NotNullCheck("k"))
        .add_check(UniquenessCheck(["k", "v"]))
        .add_check(RangeCheck("v", 0, 50))
        .add_check(AcceptedValuesCheck("s", ["a", "b"]))
        .add_check(RegexCheck("s", "^[a-c]$"))
    )


def dirty(spark):
    return spark.range(1000).selectExpr(
        "if(id % 10 = 0, null, id % 300) as k",
        "cast(id % 70 as int) as v",
        "case id % 5 when 0 then 'a' when 1 then 'b' when 2 then 'c' when 3 then 'zz' end as s",
    )


def test_suite_equals_separate_counts(spark):
    df = dirty(spark)
    got = {r.check_name: (r.total_rows, r.failing_rows) for r in make_suite().run(df)}
    n = df.count()
    assert got == {
        "row_count": (n, 0),
        "unique:k": (n, n - df.select("k").distinct().count()),
        "not_null:k": (n, df.filter("k is null").count()),
        "unique:k,v": (n, n - df.select("k", "v").distinct().count()),
        "range:v": (n, df.filter("v < 0 or v > 50").count()),
        "accepted_values:s": (n, df.filter("s not in ('a', 'b')").count()),
        "regex:s": (n, df.filter("s is not null and not s rlike '^[a-c]$'").count()),
    }


def test_suite_keeps_order_and_resets(spark):
    suite = make_suite()
    assert [r.check_name for r in suite.run(dirty(spark))] == [c.name for c in suite.checks]
    suite.run(dirty(spark).limit(5))
    assert len(suite.last_results) == 7 and suite.last_results[0].total_rows == 5


def test_results_frame_agrees_with_run(spark):
    suite = make_suite()
    frame_rows = {r["check_name"]: r.asDict() for r in suite.results(dirty(spark)).collect()}
    for result in suite.run(dirty(spark)):
        row = frame_rows[result.check_name]
        assert {k: getattr(result, k) for k in row} | {"severity": result.severity.value} == row


def test_observed_write_gives_the_same_results(spark, folder):
    suite, expected = make_suite(), make_suite().run(dirty(spark), run_ts="t")
    watched, seen = suite.observe(dirty(spark))
    watched.write.parquet(folder + "/t")
    assert suite.run(spark.read.parquet(folder + "/t"), observed=seen, run_ts="t") == expected


def test_gate_and_summary(spark):
    suite = DataQualityChecker("orders").add_check(NotNullCheck("x")).add_check(RowCountCheck())
    suite.run(frame(spark, ["A", None]))
    assert suite.summary == {"dataset": "orders", "total_checks": 2, "passed": 1, "failed": 1, "pass_rate": 0.5}
    with pytest.raises(DataQualityError, match=r"orders: not_null:x \(1/2\)"):
        suite.assert_no_failures()
    lax = DataQualityChecker("orders").add_check(NotNullCheck("x", Severity.WARN))
    lax.run(frame(spark, [None]))
    lax.assert_no_failures()
    assert DataQualityChecker("none").summary["pass_rate"] == 0.0


def test_empty_suite(spark):
    suite = DataQualityChecker("none")
    assert suite.run(spark.range(3)) == [] and suite.results(spark.range(3)).count() == 0
    suite.assert_no_failures()


def test_default_thresholds(spark):
    suite = DataQualityChecker("orders", null_threshold=0.6, duplicate_threshold=0.4)
    suite.add_check(NotNullCheck("x")).add_check(UniquenessCheck("x")).add_check(NotNullCheck("x", threshold=0.1))
    assert [r.passed for r in suite.run(frame(spark, ["A", "A", "B", None, None, None]))] == [True, False, False]


def test_persisted_rows(spark, folder):
    suite = make_suite()
    suite.persist_results(spark, folder + "/dq")
    suite.run(dirty(spark))
    suite.persist_results(spark, folder + "/dq")
    suite.run(dirty(spark))
    suite.persist_results(spark, folder + "/dq")
    stored = spark.read.parquet(folder + "/dq")
    assert stored.count() == 14 and stored.columns == RESULT_SCHEMA.fieldNames()
    row = stored.filter("check_name = 'range:v'").first()
    assert json.loads(row["details"]) == {"column": "v", "min_val": 0, "max_val": 50}
    assert row["pass_rate"] == round(row["pass_rate"], 6)


def test_details_hold_dates_and_decimals(spark):
    df = spark.createDataFrame([(datetime.date(2024, 1, 1), Decimal("1.5"))], "d date, p decimal(10,2)")
    result = one(df, RangeCheck("d", datetime.date(2023, 1, 1), datetime.date(2025, 1, 1)))
    assert result.passed and json.loads(result.to_dict()["details"])["min_val"] == "2023-01-01"
    assert one(df, RangeCheck("p", max_val=Decimal("1.4"))).failing_rows == 1


def test_own_check(spark):
    class EvenCheck(BaseCheck):
        def __init__(self, column):
            super().__init__(f"even:{column}", Severity.WARN)
            self.column = column

        def is_failing(self, schema):
            return F.col(self.column) % 2 != 0

    result = one(spark.range(5), EvenCheck("id"))
    assert (result.check_name, result.failing_rows, result.status) == ("even:id", 2, "WARN")


def test_check_with_a_run_of_its_own(spark):
    class ColumnsCheck(BaseCheck):
        def run(self, df, dataset):
            return CheckResult(self.name, dataset, "PASS", self.severity, 0, 0, 0, 1.0)

    suite = DataQualityChecker("t").add_check(RowCountCheck()).add_check(ColumnsCheck("columns"))
    suite.add_check(NotNullCheck("id"))
    assert [r.check_name for r in suite.run(spark.range(2))] == ["row_count", "columns", "not_null:id"]
    with pytest.raises(ValueError, match="columns"):
        suite.results(spark.range(2))


def test_summarise(spark):
    row = summarise(make_suite().results(dirty(spark))).first()
    assert (row["total_checks"], row["passed"], row["failed"]) == (7, 1, 6)


def test_nested_uniqueness_checks_agree_with_single_ones(spark):
    rows = [(1, "x", None), (1, "x", None), (1, "y", 2), (None, "x", 3), (None, "x", 3), (2, "z", 4)]
    df = spark.createDataFrame(rows, "a int, b string, c int")
    keys = [["a"], ["c", "b"], ["a", "b", "c"], ["b", "a"], ["b"], ["a", "a"]]
    suite = DataQualityChecker("nested")
    for columns in keys:
        suite.add_check(UniquenessCheck(columns))
    got = [(r.total_rows, r.failing_rows) for r in suite.run(df)]
    assert got == [(6, 6 - len({tuple(r["abc".index(c)] for c in k) for r in rows})) for k in keys]
    assert [(r.total_rows, r.failing_rows) for r in suite.run(df.limit(0))] == [(0, 0)] * len(keys)
