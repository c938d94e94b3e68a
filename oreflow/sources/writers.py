"""Batch writers, by format name, and the catalog registration of a path."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.functions.layout import rebalance
from oreflow.sources.paths import sql_text
from oreflow.sources.snapshots import versioned_table


def write_files(
    df: DataFrame,
    path: str,
    format: str,
    mode: str,
    partition_by: list[str] | None = None,
    dynamic_overwrite: bool = False,
    rebalanced: bool | None = None,
    options: dict[str, Any] | None = None,
) -> None:
    """``dynamic_overwrite`` replaces only the partitions that ``df`` has rows for. Rows
    are ``rebalanced`` by partition unless that is declined or there are no partitions."""
    rebalanced = bool(partition_by) if rebalanced is None else rebalanced
    writer = (rebalance(df, partition_by) if rebalanced else df).write.format(format).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic_overwrite:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.options(**(options or {})).save(path)


class ParquetWriter:
    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def write(
        self,
        df: DataFrame,
        path: str,
        mode: str = "overwrite",
        partition_by: list[str] | None = None,
        dynamic_overwrite: bool = False,
        rebalanced: bool | None = None,
        **options: Any,
    ) -> None:
        write_files(
            df, path, "parquet", mode, partition_by, dynamic_overwrite, rebalanced, options
        )


class CsvWriter:
    """CSV with a header, in the formats ``read_csv`` expects; padding is kept."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def write(
        self, df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",", **options: Any
    ) -> None:
        defaults = {
            "header": "true",
            "dateFormat": "yyyy-MM-dd",
            "timestampFormat": "yyyy-MM-dd HH:mm:ss",
            "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false",
            "sep": sep,
        }
        write_files(df, path, "csv", mode, options={**defaults, **options})


class VersionedWriter:
    """Versioned tables: Delta if the session has it, snapshots otherwise."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def write(
        self,
        df: DataFrame,
        path: str,
        mode: str = "append",
        partition_by: list[str] | None = None,
        overwrite_schema: bool = False,
        merge_schema: bool = False,
    ) -> None:
        versioned_table(self.spark, path).write(
            df, mode, partition_by, overwrite_schema, merge_schema
        )

    def upsert(
        self,
        df: DataFrame,
        path: str,
        merge_keys: list[str],
        update_columns: list[str] | None = None,
        delete_condition: str | None = None,
        **options: Any,
    ) -> None:
        versioned_table(self.spark, path).upsert(
            df, merge_keys, update_columns, delete_condition, **options
        )


DeltaWriter = VersionedWriter

WRITERS = {
    "csv": CsvWriter,
    "delta": VersionedWriter,
    "parquet": ParquetWriter,
    "snapshot": VersionedWriter,
}


def create_writer(spark: SparkSession, format: str):
    """Writer by format name, in any case. Add formats of your own to ``WRITERS``."""
    writer = WRITERS.get(format.lower())
    if writer is None:
        raise ValueError(f"unknown format {format!r}; known: {sorted(WRITERS)}")
    return writer(spark)


def write_raw(df: DataFrame, path: str, mode: str = "append") -> None:
    """Raw zone: Parquet, partitioned by the day (session time zone) of ``_ingestion_ts``."""
    by_day = df.withColumn("ingestion_date", F.to_date("_ingestion_ts"))
    write_files(by_day, path, "parquet", mode, ["ingestion_date"], rebalanced=True)


def register_table(spark: SparkSession, name: str, path: str, format: str = "parquet") -> None:
    """Make a path readable as ``name`` or ``database.name``. Does nothing if it is."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {format} LOCATION {sql_text(path)}")
