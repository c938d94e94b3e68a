"""Every registered query against its SQL, on the smallest tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver
from workload import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES) <= set(driver.queries())


def test_entry(spark):
    rows = driver.entry(spark)
    assert rows.columns == ["status", "revenue", "nb_orders"] and rows.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = driver.queries()[name](spark, SF)
    result = duck.execute(driver.oracle_sql()[name])
    columns = sorted(c[0] for c in result.description)
    assert sorted(df.columns) == columns
    places = [[c[0] for c in result.description].index(c) for c in columns]
    theirs = Counter(tuple(row[i] for i in places) for row in result.fetchall())
    ours = Counter(tuple(row) for row in df.select([f"`{c}`" for c in columns]).collect())
    assert ours == theirs and ours
