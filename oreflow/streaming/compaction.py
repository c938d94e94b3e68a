"""Few files for the closed days of a stream's table, whose batches are small folders.

The batches of closed days are written together to ``_compacted/<id>/ingest_date=<day>``; a
marker that is created afterwards names the folders it stands for. Before that, readers see
the batches, after it the compacted days. Only batches that the checkpoint has as committed
are taken: Spark replays none of them, so no batch can come back to a folder that is no
longer read. Later batches may still bring rows of a closed day; they are read besides.
Folders are not removed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.layout import rebalance
from oreflow.sources.paths import (
    create_text,
    list_names,
    literal_path,
    partition_folders,
    read_text,
)
from oreflow.streaming.ingest import DAY

_COMPACTED = "_compacted"
_LEVELS = [T.StructField("stream_id", T.StringType()), T.StructField("batch_id", T.LongType())]


class StreamTable:
    """What a ``StreamIngest`` with days has written to ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        day = T.StructField(DAY, T.DateType())
        names = {DAY, "stream_id", "batch_id"}
        self.schema = T.StructType([*(f for f in schema if f.name not in names), day, *_LEVELS])

    def _markers(self) -> list[dict]:
        folder = f"{self.path}/{_COMPACTED}"
        names = [n for n in list_names(self.spark, folder) if n.endswith(".json")]
        return [json.loads(read_text(self.spark, f"{folder}/{name}")) for name in names]

    def batches(self) -> list[str]:
        """The batches' folders, relative to the table, that no compacted day stands for."""
        gone = {folder for marker in self._markers() for folder in marker["folders"]}
        return [f for f in partition_folders(self.spark, self.path, 3) if f not in gone]

    def read(self) -> DataFrame:
        """All rows. A filter on ``ingest_date`` opens only the folders of its days."""
        parts = [(self.path, self.batches())]
        parts += [(f"{self.path}/{_COMPACTED}/{m['id']}", m["days"]) for m in self._markers()]
        scans = [self._scan(base, folders) for base, folders in parts if folders]
        out = scans[0] if scans else self.spark.createDataFrame([], self.schema)
        for scan in scans[1:]:
            out = out.unionByName(scan)
        return out

    def _scan(self, base: str, folders: list[str]) -> DataFrame:
        reader = self.spark.read.schema(self.schema).option("basePath", base)
        paths = [literal_path(f"{base}/{folder}") for folder in folders]
        return reader.parquet(*paths).select(*self.schema.names)

    def committed(self, checkpoint: str) -> tuple[str, int]:
        """The stream of a checkpoint, and its last batch that will not be replayed."""
        stream = json.loads(read_text(self.spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]
        names = list_names(self.spark, f"{checkpoint.rstrip('/')}/commits")
        return stream, max([int(n) for n in names if n.isdigit()], default=-1)

    def compact(self, checkpoint: str, before: str) -> list[str]:
        """Put together the committed batches of the days before ``before`` (``yyyy-mm-dd``).

        Days with a single folder are left alone. Returns the days.
        """
        stream, last = self.committed(checkpoint)
        by_day: dict[str, list[str]] = {}
        for folder in self.batches():
            day, of, batch = (level.split("=", 1)[1] for level in folder.split("/"))
            if day < before and of == stream and batch.isdigit() and int(batch) <= last:
                by_day.setdefault(day, []).append(folder)
        days = sorted(d for d, folders in by_day.items() if len(folders) > 1)
        folders = [f for d in days for f in by_day[d]]
        if not folders:
            return []
        name = uuid.uuid4().hex
        place = f"{self.path}/{_COMPACTED}/{name}"
        rows = rebalance(self._scan(self.path, folders), [DAY])
        rows.write.partitionBy(DAY).parquet(place)
        marker = {"id": name, "days": [f"{DAY}={d}" for d in days], "folders": folders}
        create_text(self.spark, f"{place}.json", json.dumps(marker))
        return days
