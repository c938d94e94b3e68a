import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("oreflow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A new folder for each test; nothing is cleared."""
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture
def rows_of():
    """Rows of a DataFrame as a sorted list of tuples, NULLs first."""

    def collect(df):
        rows = [tuple(row) for row in df.collect()]
        return sorted(rows, key=lambda row: [(v is not None, str(v)) for v in row])

    return collect
