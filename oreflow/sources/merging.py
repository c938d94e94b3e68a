"""Matching the rows of a table with those of a source by key.

Unless a merge is null-safe, rows with a NULL key match nothing. They go around the
joins: inside one they would all meet in a single task.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.columns import named

# Key types whose least and greatest value pass through Python unchanged.
_BOUNDED = (T.IntegralType, T.DecimalType, T.StringType, T.DateType)


#: The folder level, below the partitions, that tells the bucket of a row's keys.
BUCKET = "_bucket"

#: A source of at most so many keys has them named in the filter on the table's scan.
NAMED_KEYS = 200


@dataclass(frozen=True)
class Layout:
    """How a table's rows lie in folders: by values of some columns, then by a hash of others.
    Files have Bloom filters of the columns ``index_by``."""

    partition_by: list[str] = field(default_factory=list)
    bucket_by: list[str] = field(default_factory=list)
    buckets: int = 0
    index_by: list[str] = field(default_factory=list)

    @property
    def levels(self) -> list[str]:
        return [*self.partition_by, *([BUCKET] if self.buckets else [])]

    def bucket(self) -> Column:
        """The bucket of a row. Keys of other types than the table's have other hashes."""
        return F.pmod(F.xxhash64(*map(named, self.bucket_by)), F.lit(self.buckets)).cast("int")

    def placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, self.bucket()) if self.buckets else rows

    def file_options(self, schema: T.StructType) -> dict[str, str]:
        """Parquet options for the Bloom filters, which take the size their values need.
        Columns that folders are named by, or of types without filters, have none."""
        indexed = [
            f.name
            for f in schema
            if f.name in self.index_by
            and f.name not in self.partition_by
            and isinstance(f.dataType, (T.StringType, T.IntegerType, T.LongType))
        ]
        if not indexed:
            return {}
        on = {f"parquet.bloom.filter.enabled#{name}": "true" for name in indexed}
        return {"parquet.bloom.filter.adaptive.enabled": "true", **on}

    def reachable(self, folders: list[str], source: DataFrame, keys: list[str]) -> list[str]:
        """The folders that may hold a key of the source: those of its keys' buckets, if the
        merge is on the bucketed columns at least. At most ``buckets`` numbers are collected."""
        if not self.buckets or not set(self.bucket_by) <= set(keys):
            return folders
        hit = {f"{BUCKET}={row[0]}" for row in source.select(self.bucket()).distinct().collect()}
        return [f for f in folders if f.rsplit("/", 1)[-1] in hit]


@dataclass(frozen=True)
class Staged:
    """Rows that are written but belong to no version of a table yet."""

    df: DataFrame
    folders: list[str]
    schema: T.StructType
    layout: Layout


def all_set(keys: list[str]) -> Column:
    return reduce(Column.__and__, [named(k).isNotNull() for k in keys])


def matches(keys: list[str], null_safe: bool) -> Column:
    """Join condition between the aliases ``target`` and ``source``."""
    pairs = [(F.col(f"target.`{k}`"), F.col(f"source.`{k}`")) for k in keys]
    tests = [t.eqNullSafe(s) if null_safe else t == s for t, s in pairs]
    return reduce(Column.__and__, tests)


def keyed(rows: DataFrame, keys: list[str], null_safe: bool) -> DataFrame:
    """The rows that can match."""
    return rows if null_safe else rows.filter(all_set(keys))


def and_keyless(
    result: DataFrame, rows: DataFrame, keys: list[str], null_safe: bool
) -> DataFrame:
    """``result`` and the rows that cannot match."""
    return result if null_safe else result.unionByName(rows.filter(~all_set(keys)))


def having(rows: DataFrame, source: DataFrame, keys: list[str], null_safe: bool) -> DataFrame:
    """Rows whose key is in the source."""
    left = keyed(rows, keys, null_safe).alias("target")
    return left.join(source.alias("source"), matches(keys, null_safe), "left_semi")


def lacking(rows: DataFrame, source: DataFrame, keys: list[str], null_safe: bool) -> DataFrame:
    """Rows whose key is not in the source."""
    left = keyed(rows, keys, null_safe).alias("target")
    out = left.join(source.alias("source"), matches(keys, null_safe), "left_anti")
    return and_keyless(out, rows, keys, null_safe)


def updated(
    rows: DataFrame,
    source: DataFrame,
    keys: list[str],
    null_safe: bool,
    changed: list[str],
    delete_condition: str | None,
) -> DataFrame:
    """Rows with the changed columns of their match, less those to be deleted."""
    left = keyed(rows, keys, null_safe).alias("target")
    right = source.withColumn("__hit", F.lit(True)).alias("source")
    joined = left.join(right, matches(keys, null_safe), "left")
    if delete_condition:
        goes = F.col("__hit") & F.expr(f"({delete_condition})")
        joined = joined.filter(~F.coalesce(goes, F.lit(False)))
    columns = []
    for f in rows.schema:
        old, new = F.col(f"target.`{f.name}`"), F.col(f"source.`{f.name}`").cast(f.dataType)
        value = F.when(F.col("__hit"), new).otherwise(old) if f.name in changed else old
        columns.append(value.alias(f.name))
    return and_keyless(joined.select(*columns), rows, keys, null_safe)


@dataclass(frozen=True)
class KeyProfile:
    """What one pass over a source's keys tells: their range, and whether any repeats."""

    bounds: dict[str, tuple[Any, Any]]
    most_rows: int
    #: The keys themselves, if all are of plain types and ``NAMED_KEYS`` at most.
    listed: list[dict[str, Any]] | None = None

    def within_bounds(self, null_safe: bool) -> Column:
        """The range the keys span, and the keys if they are few, as a filter that reaches
        the Parquet scan.

        Files and row groups outside the range are skipped by their statistics, which is most
        of the table if keys grow with time; of the others, those whose Bloom filters
        have none of the keys. The keys are tests of equality, not a list: of longer lists
        Spark hands only the range to Parquet.
        """
        inside = F.lit(True)
        for key, (least, greatest) in self.bounds.items():
            test = named(key).between(F.lit(least), F.lit(greatest))
            inside = inside & (named(key).isNull() | test if null_safe else test)
        tests = []
        for row in self.listed or ():
            pairs = [(named(k), F.lit(v)) for k, v in row.items()]
            equal = [c.isNull() if row[k] is None else c == v for k, (c, v) in zip(row, pairs)]
            tests.append(reduce(Column.__and__, equal))
        while len(tests) > 1:  # a balanced tree, not a deep one
            halves = [tests[i : i + 2] for i in range(0, len(tests), 2)]
            tests = [reduce(Column.__or__, half) for half in halves]
        return inside & tests[0] if tests else inside


def profile_keys(
    source: DataFrame, keys: list[str], null_safe: bool, count_rows: bool
) -> KeyProfile:
    """Rows per key are counted, which shuffles the keys, only on request."""
    bounded = [k for k in keys if isinstance(source.schema[k].dataType, _BOUNDED)]
    rows = keyed(source.select(*map(named, keys)), keys, null_safe)
    whole = rows
    if count_rows:
        rows = rows.groupBy(*map(named, keys)).agg(F.count(F.lit(1)).alias("__rows"))
    else:
        rows = rows.withColumn("__rows", F.lit(1))
    ends = [F.struct(F.min(named(k)), F.max(named(k))) for k in bounded]
    *found, most, n_keys = rows.agg(*ends, F.max("__rows"), F.count(F.lit(1))).first()
    listed = None
    if 0 < n_keys <= NAMED_KEYS and bounded == list(keys):
        listed = [row.asDict() for row in whole.collect()] if (most or 0) <= 1 else None
    return KeyProfile({k: tuple(end) for k, end in zip(bounded, found)}, most or 0, listed)


def repeated_key(source: DataFrame, keys: list[str], null_safe: bool) -> dict[str, Any]:
    """A key that several rows have."""
    counted = keyed(source, keys, null_safe).groupBy(*map(named, keys)).count()
    return counted.filter("count > 1").drop("count").first().asDict()
