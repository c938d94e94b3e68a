"""Checks of a table that grows by loads, from states that add up.

Each load leaves its own counts: rows and failing rows of every check, and for uniqueness the
rows of each key. A later check adds these, so it reads the new load and the stored keys, and
the data of no earlier load.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.functions.columns import named
from oreflow.operators.quality import DataQualityChecker, rows_per_key


class IncrementalChecks:
    """A suite over all loads of a table, with its states below ``path``.

    Foreign keys are counted against the other table as it is at the load. The suite must not
    hold checks with a run of their own, and must stay the same from load to load.
    """

    def __init__(self, checker: DataQualityChecker, path: str) -> None:
        alone = [check.name for check in checker.checks if check.runs_alone]
        if alone:
            raise ValueError(f"these checks have no counts that add up: {alone}")
        self.checker, self.path = checker, path.rstrip("/")

    def add(self, rows: DataFrame, load: str) -> None:
        """Store the counts of a load; one of the same name, such as a replay's, is replaced."""
        counts = self.checker.added_counts(rows)
        if counts:
            self._put(reduce(DataFrame.unionAll, counts), "counts", load)
        for chain in self.checker.key_chains():
            keys = self.checker.checks[chain[0]].keys
            self._put(rows_per_key(rows, keys), f"keys_{chain[0]}", load)

    def results(self, spark: SparkSession) -> DataFrame:
        """One row per check over all loads, like ``DataQualityChecker.results``."""
        parts = []
        if self.checker.added_counts_positions():
            sums = [F.sum(c).alias(c) for c in ("total_rows", "failing")]
            parts.append(self._all(spark, "counts").groupBy("position").agg(*sums))
        for chain in self.checker.key_chains():
            keys = dict.fromkeys(self.checker.checks[chain[0]].keys)
            stored = self._all(spark, f"keys_{chain[0]}")
            per_key = stored.groupBy(*map(named, keys)).agg(F.sum("__rows").alias("__rows"))
            parts.append(self.checker.repeats(per_key, chain))
        if not parts:
            raise ValueError("the suite has no checks")
        return self.checker.judge(reduce(DataFrame.unionAll, parts)).drop("position", "failing")

    def _put(self, state: DataFrame, name: str, load: str) -> None:
        out = state.withColumn("load", F.lit(load)).write.mode("overwrite")
        out = out.option("partitionOverwriteMode", "dynamic").partitionBy("load")
        out.parquet(f"{self.path}/{name}")

    def _all(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.path}/{name}").drop("load")
