"""Delta tables through Spark's own API, for sessions that have Delta configured."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from oreflow.sources.merging import Layout, Staged
from oreflow.sources.paths import literal_path, sql_text


# The error conditions that say there is no table.
_ABSENT = (
    "DELTA_MISSING_DELTA_TABLE",
    "DELTA_PATH_DOES_NOT_EXIST",
    "DELTA_TABLE_NOT_FOUND",
    "PATH_NOT_FOUND",
    "TABLE_OR_VIEW_NOT_FOUND",
)


def has_delta(spark: SparkSession) -> bool:
    return "io.delta" in (spark.conf.get("spark.sql.extensions", "") or "")


class DeltaTable:
    """Reads, writes, upserts and registration as ``SnapshotTable`` has them, by Delta."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.name = f"delta.`{path}`"

    def exists(self) -> bool:
        try:
            self.spark.sql(f"DESCRIBE DETAIL {self.name}").collect()
        except AnalysisException as error:
            if error.getCondition() not in _ABSENT:
                raise
            return False
        return True

    def register(self, name: str) -> None:
        location = sql_text(self.path)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING delta LOCATION {location}")

    def read(self, version: int | None = None, timestamp: str | None = None) -> DataFrame:
        reader = self.spark.read.format("delta")
        if version is not None:
            reader = reader.option("versionAsOf", version)
        elif timestamp is not None:
            reader = reader.option("timestampAsOf", timestamp)
        return reader.load(self.path)

    def write(
        self,
        df: DataFrame,
        mode: str = "append",
        partition_by: list[str] | None = None,
        overwrite_schema: bool = False,
        merge_schema: bool = False,
    ) -> None:
        writer = df.write.format("delta").mode(mode)
        if overwrite_schema:
            writer = writer.option("overwriteSchema", True)
        if merge_schema:
            writer = writer.option("mergeSchema", True)
        (writer.partitionBy(*partition_by) if partition_by else writer).save(self.path)

    def stage(
        self,
        df: DataFrame,
        partition_by: list[str] | None = None,
        observe: Callable[[DataFrame], DataFrame] | None = None,
    ) -> Staged:
        """Write rows next to the table, to be checked and then passed to ``upsert``."""
        place = f"{self.path.rstrip('/')}__staging/{uuid.uuid4().hex}"
        (observe(df) if observe else df).write.parquet(place)
        written = self.spark.read.schema(df.schema).parquet(literal_path(place))
        return Staged(written, [], df.schema, Layout(list(partition_by or [])))

    def upsert(
        self,
        df: DataFrame | Staged,
        merge_keys: list[str],
        update_columns: list[str] | None = None,
        delete_condition: str | None = None,
        null_safe: bool = False,
        merge_schema: bool = False,
        unique_source: bool = False,
        partition_by: list[str] | None = None,
    ) -> None:
        """Delta itself looks for repeated source keys, so ``unique_source`` changes nothing."""
        if isinstance(df, Staged):
            df, partition_by = df.df, df.layout.partition_by
        if not self.exists():
            self.write(df, "error", partition_by)
            return
        evolving = "WITH SCHEMA EVOLUTION" if merge_schema else ""
        equals = "<=>" if null_safe else "="
        on = " AND ".join(f"target.`{k}` {equals} source.`{k}`" for k in merge_keys)
        changes = ", ".join(f"target.`{c}` = source.`{c}`" for c in update_columns or [])
        delete = f"WHEN MATCHED AND ({delete_condition}) THEN DELETE" if delete_condition else ""
        self.spark.sql(
            f"MERGE {evolving} INTO {self.name} AS target USING {{source}} AS source ON {on} {delete} "
            f"WHEN MATCHED THEN UPDATE SET {changes or '*'} WHEN NOT MATCHED THEN INSERT *",
            source=df,
        )
