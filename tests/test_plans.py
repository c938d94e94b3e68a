"""Plans of operators and of every registered query, as they must hold at scale."""

import pytest

from oreflow import DataQualityChecker, DropNullKeys, KeepLatest, NotNullCheck, UniquenessCheck
from oreflow.operators.quality import RangeCheck, ReferentialCheck
from oreflow.plans.flows import clean_orders
from workload import QUERIES
from workload.inputs import raw_orders

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lineitem(spark):
    return spark.read.parquet(f"{SF}/lineitem.parquet")


def test_keep_latest_limits_each_key_before_the_shuffle(lineitem):
    text = plan(KeepLatest(["l_orderkey"], ["l_shipdate"])(lineitem))
    before = text[text.index("Exchange") :]
    assert text.count("Exchange") == 1 and "WindowGroupLimit" in before and "Partial" in before


def test_null_key_filter_is_pushed_to_the_scan(lineitem):
    text = plan(DropNullKeys(["l_orderkey"])(lineitem).select("l_orderkey"))
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in text
    assert "ReadSchema: struct<l_orderkey:bigint>" in text


def test_row_checks_share_one_scan_and_uniqueness_reads_only_its_keys(lineitem):
    suite = DataQualityChecker("lineitem")
    for check in (NotNullCheck("l_tax"), RangeCheck("l_quantity", 0, 50), UniquenessCheck("l_orderkey")):
        suite.add_check(check)
    text = plan(suite.results(lineitem))
    assert text.count("FileScan") == 2
    assert "ReadSchema: struct<l_quantity:double,l_tax:double>" in text
    assert "ReadSchema: struct<l_orderkey:bigint>" in text
    assert "Expand" not in text


def test_nested_key_sets_are_counted_in_one_pass(spark):
    assert plan(QUERIES["dq_suite"](spark, SF)).count("FileScan") == 6


def test_referential_check_joins_counted_keys(lineitem, spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    suite = DataQualityChecker("lineitem").add_check(ReferentialCheck("l_orderkey", orders, "o_orderkey"))
    text = plan(suite.results(lineitem))
    join = text.index("Join")
    assert "HashAggregate" in text[join:] and "partial_count(1)" in text[join:]


def test_silver_orders_shuffles_once(spark):
    text = plan(clean_orders()(raw_orders(spark, SF)))
    assert text.count("Exchange hashpartitioning") == 1


LAZY = sorted(set(QUERIES) - {"stream_ingest"})


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_pairwise_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin", "RDDScan"):
        assert node not in text
