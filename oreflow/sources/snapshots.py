"""Versioned tables on plain Parquet folders: time travel, upsert, rollback, diff.

This is a folder convention for one writer at a time, not a transaction log. Every write
goes into a new folder ``<path>/_batch=<id>/[<column>=<value>/...]`` and becomes visible
when a small marker ``<path>/_commits/<version>.json`` names the folders that make up the
new version. Folders no marker names are ignored, so a failed write leaves the last
version as it was, and a version is never changed afterwards.

Versions share folders. An append writes its own rows only; an upsert rewrites only
folders that hold a matching key, found by reading nothing but the keys, and in a table
with buckets only those of the source's own buckets; a rollback writes a marker. The marker lists folders, not files, and lists are all the driver holds.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_right
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import datetime, timedelta, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.columns import named
from oreflow.functions.layout import rebalance
from oreflow.sources.delta import DeltaTable, has_delta
from oreflow.sources.merging import (
    BUCKET,
    Layout,
    Staged,
    having,
    keyed,
    lacking,
    profile_keys,
    repeated_key,
    updated,
)
from oreflow.sources.paths import (
    create_text,
    list_names,
    literal_path,
    partition_folders,
    read_text,
    sql_text,
)

_BATCH = "_batch"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder name for NULL


class MergeConflictError(ValueError):
    """The source of an upsert has several rows for a key."""


@dataclass(frozen=True)
class Snapshot:
    """One version: its schema, and the folders (relative to the table) it consists of."""

    version: int
    committed_at: str
    operation: str
    schema_json: str
    partition_by: list[str]
    folders: list[str]
    bucket_by: list[str] = field(default_factory=list)
    buckets: int = 0
    #: The last batch of each stream that has been merged in.
    applied: dict[str, int] = field(default_factory=dict)
    index_by: list[str] = field(default_factory=list)

    @property
    def layout(self) -> Layout:
        return Layout(self.partition_by, self.bucket_by, self.buckets, self.index_by)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema_json))

    @property
    def committed(self) -> datetime:
        return datetime.fromisoformat(self.committed_at)


def _layout(
    partition_by: list[str] | None,
    bucket_by: list[str] | None,
    buckets: int,
    index_by: list[str] | None,
) -> Layout:
    if bool(bucket_by) != bool(buckets):
        raise ValueError("bucket_by and buckets go together")
    return Layout(list(partition_by or []), list(bucket_by or []), buckets, list(index_by or []))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # -- versions ------------------------------------------------------------------

    def versions(self) -> list[int]:
        names = list_names(self.spark, f"{self.path}/_commits")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def exists(self) -> bool:
        return bool(self.versions())

    def _marker(self, version: int) -> str:
        return f"{self.path}/_commits/{version:020d}.json"

    def _load(self, version: int) -> Snapshot:
        return Snapshot(**json.loads(read_text(self.spark, self._marker(version))))

    def snapshot(
        self, version: int | None = None, timestamp: str | datetime | None = None
    ) -> Snapshot:
        """A version by number or commit time; the number wins; neither means the latest.

        A time before the first commit or after the last is an error.
        """
        versions = self.versions()
        if not versions:
            raise FileNotFoundError(f"no versioned table at {self.path}")
        if version is not None:
            if version not in versions:
                raise ValueError(f"version {version} not in {versions[0]}..{versions[-1]}")
            return self._load(version)
        if timestamp is None:
            return self._load(versions[-1])
        moment = self._moment(timestamp)
        older = bisect_right(versions, moment, key=lambda v: self._load(v).committed)
        if older == 0:
            raise ValueError(f"{timestamp} is before the first commit")
        found = self._load(versions[older - 1])
        if older == len(versions) and moment > found.committed:
            raise ValueError(f"{timestamp} is after the last commit, {found.committed_at}")
        return found

    def _moment(self, timestamp: str | datetime) -> datetime:
        """A time as Spark reads it: in the session's zone unless it names its own."""
        if isinstance(timestamp, datetime):
            timestamp = timestamp.isoformat()
        micros = F.unix_micros(F.lit(timestamp).try_cast("timestamp"))
        found = self.spark.range(1).select(micros).first()[0]
        if found is None:
            raise ValueError(f"{timestamp!r} is not a timestamp")
        return datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=found)

    def _commit(
        self,
        operation: str,
        schema: T.StructType,
        layout: Layout | list[str],
        folders: list[str],
        previous: Snapshot | None,
        applied: dict[str, int] | None = None,
    ) -> Snapshot:
        layout = layout if isinstance(layout, Layout) else Layout(layout)
        now = datetime.now(timezone.utc)
        if previous:
            now = max(now, previous.committed + timedelta(microseconds=1))
        made = Snapshot(
            version=previous.version + 1 if previous else 0,
            committed_at=now.isoformat(),
            operation=operation,
            schema_json=schema.json(),
            folders=sorted(folders),
            applied={**(previous.applied if previous else {}), **(applied or {})},
            **asdict(layout),
        )
        create_text(self.spark, self._marker(made.version), json.dumps(asdict(made)))
        return made

    def _latest(self) -> Snapshot | None:
        versions = self.versions()
        return self._load(versions[-1]) if versions else None

    # -- reading -------------------------------------------------------------------

    def read(
        self, version: int | None = None, timestamp: str | datetime | None = None
    ) -> DataFrame:
        found = self.snapshot(version, timestamp)
        return self._scan(found.folders, found.schema).select(*map(named, found.schema.names))

    def _scan(self, folders: list[str], schema: T.StructType) -> DataFrame:
        """The rows of some folders. Columns a folder's files lack read as NULL."""
        if not folders:
            return self.spark.createDataFrame([], schema)
        full = T.StructType([*schema.fields, T.StructField(_BATCH, T.StringType())])
        reader = self.spark.read.schema(full).option("basePath", self.path)
        return reader.parquet(*[literal_path(f"{self.path}/{folder}") for folder in folders])

    # -- writing -------------------------------------------------------------------

    def _put(
        self,
        df: DataFrame,
        layout: Layout,
        observe: Callable[[DataFrame], DataFrame] | None = None,
    ) -> list[str]:
        """Write rows, rebalanced by partition and bucket, to a new folder; the folders, one
        per partition value and bucket. Without rows there is none."""
        folder = f"{_BATCH}=b{uuid.uuid4().hex[:16]}"
        rows = rebalance(layout.placed(df), layout.levels)
        writer = (observe(rows) if observe else rows).write.options(**layout.file_options(df.schema))
        if layout.levels:
            writer = writer.partitionBy(*layout.levels)
        writer.parquet(f"{self.path}/{folder}")
        if not layout.levels:
            return [] if self._scan([folder], df.schema).isEmpty() else [folder]
        found = partition_folders(self.spark, f"{self.path}/{folder}", len(layout.levels))
        return [f"{folder}/{name}" for name in found]

    def _conform(
        self,
        df: DataFrame,
        current: Snapshot | None,
        merge_schema: bool,
        require_all: bool,
        ignore_extra: bool,
    ) -> DataFrame:
        """Columns of the table, in its order and types, then new ones if allowed."""
        if current is None:
            return df
        schema = current.schema
        missing = [n for n in schema.names if n not in df.columns]
        extra = [n for n in df.columns if n not in schema.names]
        if missing and require_all:
            raise ValueError(f"the source lacks columns of the table: {missing}")
        if extra and not merge_schema and not ignore_extra:
            raise ValueError(f"columns unknown to the table: {extra}; see merge_schema")
        kept = [
            (F.lit(None) if f.name in missing else named(f.name)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
        return df.select(*kept, *(map(named, extra) if merge_schema else []))

    def stage(
        self,
        df: DataFrame,
        partition_by: list[str] | None = None,
        merge_schema: bool = False,
        observe: Callable[[DataFrame], DataFrame] | None = None,
        require_all: bool = True,
        ignore_extra: bool = True,
        bucket_by: list[str] | None = None,
        buckets: int = 0,
        index_by: list[str] | None = None,
    ) -> Staged:
        """Write rows without publishing them, to be checked and then passed to
        ``write`` or ``upsert``. ``observe`` may attach an observation to the rows; it
        sits right before the write, after any shuffle. The layout holds for a new table;
        an existing one keeps its own."""
        current = self._latest()
        layout = current.layout if current else _layout(partition_by, bucket_by, buckets, index_by)
        rows = self._conform(df, current, merge_schema, require_all, ignore_extra)
        schema = _nullable(rows.schema)
        folders = self._put(rows, layout, observe)
        tops = sorted({folder.split("/")[0] for folder in folders})
        written = self._scan(tops, schema).select(*map(named, schema.names))
        return Staged(written, folders, schema, layout)

    def write(
        self,
        df: DataFrame | Staged,
        mode: str = "append",
        partition_by: list[str] | None = None,
        overwrite_schema: bool = False,
        merge_schema: bool = False,
        bucket_by: list[str] | None = None,
        buckets: int = 0,
        index_by: list[str] | None = None,
    ) -> Snapshot | None:
        """Modes append, overwrite, error and ignore (the last two if the table exists).

        An append may leave columns out and, with ``merge_schema``, bring new ones; rows
        on the other side read as NULL there. ``overwrite_schema`` lets an overwrite
        change columns and partitioning. The files of a new table get Bloom filters of the
        columns ``index_by``, by which a merge of few keys skips those without them.
        """
        current = self._latest()
        if current and mode in ("error", "errorifexists"):
            raise ValueError(f"a versioned table exists at {self.path}")
        if current and mode == "ignore":
            return None
        if mode not in ("append", "overwrite", "error", "errorifexists", "ignore"):
            raise ValueError(f"unknown mode {mode!r}")
        if current and mode == "overwrite" and overwrite_schema:
            layout = _layout(partition_by, bucket_by, buckets, index_by)
            folders, schema = self._put(df, layout), _nullable(df.schema)
            return self._commit("overwrite", schema, layout, folders, current)
        staged = df
        if not isinstance(df, Staged):
            staged = self.stage(
                df,
                partition_by,
                merge_schema,
                require_all=False,
                ignore_extra=False,
                bucket_by=bucket_by,
                buckets=buckets,
                index_by=index_by,
            )
        kept = current.folders if current and mode == "append" else []
        folders = [*kept, *staged.folders]
        return self._commit(mode, staged.schema, staged.layout, folders, current)

    def rollback(self, version: int) -> Snapshot:
        """Make an earlier version the latest again. Copies no data."""
        old = self.snapshot(version)
        return self._commit(
            f"rollback to {version}", old.schema, old.layout, old.folders, self._latest()
        )

    # -- upsert --------------------------------------------------------------------

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
        buckets: int = 0,
        batch: tuple[str, int] | None = None,
    ) -> Snapshot:
        """Insert new keys and update existing ones; a missing table is created.

        ``update_columns`` limits what a match changes. ``delete_condition``, over
        ``source.x`` and ``target.x``, removes the matched rows it holds for. NULL keys
        never match unless ``null_safe``. A source with several rows for a key is an
        error; ``unique_source`` skips that check for a source known to have none.

        A new table may get ``buckets``: its rows lie in so many folders by a hash of the
        merge keys, and later merges on them read and rewrite only their keys' buckets. Its
        files get Bloom filters of the merge keys.
        ``batch``, a stream and a batch number, makes a merge happen once: a batch that is
        not after the stream's last one changes nothing.
        """
        current = self._latest()
        applied = dict([batch]) if batch else None
        if batch and current and current.applied.get(batch[0], -1) >= batch[1]:
            return current
        partial = current is not None and bool(update_columns or delete_condition)
        if isinstance(df, Staged):
            staged = df
        elif partial:
            staged = self._stage_aside(df, current, merge_keys)
        else:
            bucket_by = merge_keys if buckets else None
            staged = self.stage(
                df,
                partition_by,
                merge_schema,
                bucket_by=bucket_by,
                buckets=buckets,
                index_by=merge_keys,
            )

        def commit(schema: T.StructType, layout: Layout, folders: list[str]) -> Snapshot:
            return self._commit("upsert", schema, layout, folders, current, applied)

        if current is None and unique_source:
            return commit(staged.schema, staged.layout, staged.folders)
        profile = profile_keys(staged.df, merge_keys, null_safe, count_rows=not unique_source)
        if profile.most_rows > 1:
            example = repeated_key(staged.df, merge_keys, null_safe)
            raise MergeConflictError(f"several source rows for {example}")
        if current is None:
            return commit(staged.schema, staged.layout, staged.folders)

        source = keyed(staged.df, merge_keys, null_safe)
        touched = self._touched(
            current, source, merge_keys, null_safe, profile.within_bounds(null_safe)
        )
        old = self._scan(touched, current.schema).select(*map(named, current.schema.names))
        kept = [f for f in current.folders if f not in set(touched)]
        if partial:
            schema, folders = current.schema, []
            changed = schema.names if update_columns is None else update_columns
            unknown = [c for c in changed if c not in schema.names]
            if unknown:
                raise ValueError(f"update_columns unknown to the table: {unknown}")
            matched = having(old.select(*map(named, merge_keys)), source, merge_keys, null_safe)
            rows = lacking(staged.df, matched.distinct(), merge_keys, null_safe)
            rows = rows.select(*[named(f.name).cast(f.dataType).alias(f.name) for f in schema])
            if touched:
                rows = rows.unionByName(
                    updated(old, source, merge_keys, null_safe, changed, delete_condition)
                )
            folders += self._put(rows, current.layout)
        else:
            schema, folders = staged.schema, list(staged.folders)
            if touched:
                rows = lacking(old, source.select(*map(named, merge_keys)), merge_keys, null_safe)
                folders += self._put(rows, current.layout)
        return commit(schema, current.layout, [*kept, *folders])

    def _stage_aside(self, df: DataFrame, current: Snapshot, keys: list[str]) -> Staged:
        """Write a source, with all its columns, that is only to be merged from. Its keys
        take the table's types, so that their range is that of the table's keys."""
        missing = [n for n in current.schema.names if n not in df.columns]
        if missing:
            raise ValueError(f"the source lacks columns of the table: {missing}")
        place = f"{self.path}/_staging/{uuid.uuid4().hex}"
        kinds = {f.name: f.dataType for f in current.schema}
        df = df.withColumns({k: named(k).cast(kinds[k]) for k in keys})
        df.write.parquet(place)
        staged = self.spark.read.schema(df.schema).parquet(literal_path(place))
        return Staged(staged, [], df.schema, Layout())

    def _touched(
        self,
        current: Snapshot,
        source: DataFrame,
        keys: list[str],
        null_safe: bool,
        bounds: Column,
    ) -> list[str]:
        """Folders that hold a key of the source. Reads the key columns only, and of a table
        with buckets only the source's."""
        reachable = current.layout.reachable(current.folders, source, keys)
        if not reachable:
            return []
        target = self._scan(reachable, current.schema).select(
            *map(named, keys), F.col("_metadata.file_path").alias("__file")
        )
        wanted = source.select(*map(named, keys))
        hits = having(target.filter(bounds), wanted, keys, null_safe)
        folder = F.regexp_extract("__file", "^(.*)/[^/]*$", 1)
        hit_folders = hits.select("__file").distinct().select(folder).distinct()
        depth = 1 + len(current.layout.levels)
        found = {"/".join(unquote(row[0]).split("/")[-depth:]) for row in hit_folders.collect()}
        if unknown := found - set(current.folders):
            raise RuntimeError(f"matches in folders the version does not name: {sorted(unknown)}")
        return [f for f in current.folders if f in found]

    # -- comparing and registering -------------------------------------------------

    def diff(self, from_version: int, to_version: int, keys: list[str]) -> DataFrame:
        """Keys whose rows differ between two versions, as added, removed or changed.

        Folders both versions share hold the same rows; of them only the keys are read, to
        tell a key that was there before and still is from one that came or went. All rows
        are dealt by key once; equal rows of a key are then counted on each side and folded
        into the key's, so repeated and NULL keys do not multiply.
        """
        old, new = self.snapshot(from_version), self.snapshot(to_version)
        shared = sorted(set(old.folders) & set(new.folders))
        sides = []
        for snapshot, before in ((old, 1), (new, 0)):
            own = [f for f in snapshot.folders if f not in shared]
            rows = self._scan(own, snapshot.schema).select(*map(named, snapshot.schema.names))
            counts = {"__before": F.lit(before), "__after": F.lit(1 - before), "__own": F.lit(True)}
            sides.append(rows.withColumns(counts))
        rows = sides[0].unionByName(sides[1], allowMissingColumns=True)
        if shared:
            kept = self._scan(shared, new.schema).select(*map(named, keys))
            once = {"__before": F.lit(1), "__after": F.lit(1), "__own": F.lit(False)}
            rows = rows.unionByName(kept.withColumns(once), allowMissingColumns=True)
        values = [c for c in rows.columns if c not in ("__before", "__after")]
        before, after = F.sum("__before").alias("__before"), F.sum("__after").alias("__after")
        change = (
            F.when(F.col("__before") == 0, "added")
            .when(F.col("__after") == 0, "removed")
            .otherwise("changed")
        )
        unequal = F.count_if(F.col("__before") != F.col("__after")).alias("__unequal")
        dealt = rows.repartition(*map(named, keys))
        return (
            dealt.groupBy(*map(named, values))
            .agg(before, after)
            .groupBy(*map(named, keys))
            .agg(unequal, before, after)
            .filter("__unequal > 0")
            .select(*map(named, keys), change.alias("change"))
        )

    def register(self, name: str) -> None:
        """Point a catalog table at the latest version: one catalog partition per folder.

        Call it again after a commit. It changes the catalog only; while it runs, a
        query by name may see a mix of versions, whereas reads by path never do.
        """
        current = self.snapshot()
        parts = [_BATCH, *current.layout.levels]
        columns = [f for f in current.schema if f.name not in parts]
        own = {_BATCH: T.StringType(), BUCKET: T.IntegerType()}
        kinds = {f.name: f.dataType for f in current.schema} | own
        keys = [T.StructField(name, kinds[name]) for name in parts]
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*columns, *keys])
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet "
            f"PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)}) LOCATION {sql_text(self.path)}"
        )
        known = {row[0] for row in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}
        for gone in sorted(known - set(current.folders)):
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({_spec(gone)})")
        fresh = [f for f in current.folders if f not in known]
        for start in range(0, len(fresh), 500):
            specs = " ".join(
                f"PARTITION ({_spec(f)}) LOCATION {sql_text(f'{self.path}/{f}')}"
                for f in fresh[start : start + 500]
            )
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")


def _spec(folder: str) -> str:
    """``a=1/b=x`` as the partition clause ``a='1', b='x'``."""
    pairs = [part.split("=", 1) for part in folder.split("/")]
    return ", ".join(
        f"`{name}`=" + ("null" if value == _NO_VALUE else sql_text(unquote(value)))
        for name, value in pairs
    )


def versioned_table(spark: SparkSession, path: str) -> DeltaTable | SnapshotTable:
    """Delta if the session has it, snapshots otherwise."""
    return DeltaTable(spark, path) if has_delta(spark) else SnapshotTable(spark, path)
