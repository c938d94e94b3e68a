"""How rows are laid out over tasks before a write."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from oreflow.functions.columns import named


def repartition_by_size(
    df: DataFrame, target_file_size_mb: float, total_size_mb: float
) -> DataFrame:
    """As many partitions as files of the target size make up the total."""
    return df.repartition(max(1, math.ceil(total_size_mb / target_file_size_mb)))


def rebalance(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """Bring the rows of an output partition together, so each gets few files.

    Without it every task writes a file into every partition it has rows for. Unlike
    ``repartition``, adaptive execution then splits a partition value that holds a
    large share of the rows, and joins small ones.
    """
    return df.hint("rebalance", *map(named, partition_by)) if partition_by else df
