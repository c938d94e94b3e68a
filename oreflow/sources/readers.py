"""Batch readers, by format name. All are lazy and leave pruning to Catalyst."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from oreflow.sources.snapshots import versioned_table

Schema = T.StructType | str | None

# Reading defaults of the CSV format, which keyword options override.
CSV_DEFAULTS = {
    "header": "true",
    "encoding": "UTF-8",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "mode": "PERMISSIVE",
    "inferSchema": "false",
}


def read_files(
    spark: SparkSession, format: str, path: str, schema: Schema, options: dict[str, Any]
) -> DataFrame:
    reader = spark.read.format(format).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def read_parquet(
    spark: SparkSession, path: str, schema: Schema = None, merge_schema: bool = False, **_: Any
) -> DataFrame:
    return read_files(spark, "parquet", path, schema, {"mergeSchema": merge_schema})


def read_csv(
    spark: SparkSession, path: str, schema: Schema = None, sep: str = ",", **options: Any
) -> DataFrame:
    """Bad fields become NULL. Without a schema every column is a string."""
    return read_files(spark, "csv", path, schema, {**CSV_DEFAULTS, "sep": sep, **options})


def read_json(
    spark: SparkSession, path: str, schema: Schema = None, multiline: bool = False, **options: Any
) -> DataFrame:
    """JSON Lines, or whole-file JSON with ``multiline`` (such files cannot be split).
    Without a schema Spark reads the data twice to infer one."""
    return read_files(spark, "json", path, schema, {"multiLine": multiline, **options})


def read_avro(spark: SparkSession, path: str, schema: Schema = None, **options: Any) -> DataFrame:
    """Needs Spark's Avro connector on the classpath."""
    return read_files(spark, "avro", path, schema, options)


def read_versioned(
    spark: SparkSession,
    path: str,
    version: int | None = None,
    timestamp: str | None = None,
) -> DataFrame:
    """A versioned table now, at a version, or at a time; the version wins over the time."""
    return versioned_table(spark, path).read(version=version, timestamp=timestamp)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    lower_bound: Any = None,
    upper_bound: Any = None,
    num_partitions: int | None = None,
    **properties: Any,
) -> DataFrame:
    """A table over JDBC, in ``num_partitions`` parallel ranges of ``partition_column``.

    The bounds set the stride only: rows outside them, and NULLs, are read as well.
    """
    options = jdbc_options(
        url, table, user, password, partition_column, lower_bound, upper_bound, num_partitions
    )
    return spark.read.format("jdbc").options(**options, **properties).load()


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    lower_bound: Any = None,
    upper_bound: Any = None,
    num_partitions: int | None = None,
) -> dict[str, Any]:
    options = {"url": url, "dbtable": table, "user": user, "password": password}
    split = {
        "partitionColumn": partition_column,
        "lowerBound": lower_bound,
        "upperBound": upper_bound,
        "numPartitions": num_partitions,
    }
    unset = [name for name, value in split.items() if value is None]
    if unset and len(unset) < len(split):
        raise ValueError(f"a partitioned read also needs {', '.join(unset)}")
    return {n: v for n, v in {**options, **split}.items() if v is not None}


def read_table(spark: SparkSession, name: str, **_: Any) -> DataFrame:
    """A table or view of the catalog."""
    return spark.table(name)


READERS: dict[str, Callable[..., DataFrame]] = {
    "avro": read_avro,
    "csv": read_csv,
    "delta": read_versioned,
    "jdbc": read_jdbc,
    "json": read_json,
    "parquet": read_parquet,
    "snapshot": read_versioned,
    "table": read_table,
}


class Reader:
    """A registered read function bound to a session."""

    def __init__(self, spark: SparkSession, function: Callable[..., DataFrame]) -> None:
        self.spark, self.function = spark, function

    def read(self, *args: Any, **kwargs: Any) -> DataFrame:
        return self.function(self.spark, *args, **kwargs)


def create_reader(spark: SparkSession, format: str) -> Reader:
    """Reader by format name, in any case. Add formats of your own to ``READERS``."""
    function = READERS.get(format.lower())
    if function is None:
        raise ValueError(f"unknown format {format!r}; known: {sorted(READERS)}")
    return Reader(spark, function)


ParquetReader = partial(create_reader, format="parquet")
CsvReader = partial(create_reader, format="csv")
JsonReader = partial(create_reader, format="json")
DeltaReader = partial(create_reader, format="delta")
JdbcReader = partial(create_reader, format="jdbc")
