"""Paths and the few file-system calls the versioned tables need."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def zone_path(base: str, zone: str, *parts: str) -> str:
    """``base/zone/part/...``; empty parts are left out."""
    return "/".join([base.rstrip("/"), *(p.strip("/") for p in (zone, *parts) if p)])


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/oreflow/{name}-{uuid.uuid4().hex}"


def _locate(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; empty if it does not exist."""
    files, location = _locate(spark, folder)
    if not files.exists(location):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(location))


def partition_folders(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Paths, relative to ``folder``, of its ``name=value`` folders ``depth`` levels down."""
    found = [""]
    for _ in range(depth):
        found = [
            f"{above}/{name}".lstrip("/")
            for above in found
            for name in list_names(spark, f"{folder}/{above}".rstrip("/"))
            if "=" in name
        ]
    return found


def literal_path(path: str) -> str:
    """A path for Spark's readers, which would take these signs for patterns."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def read_text(spark: SparkSession, path: str) -> str:
    files, location = _locate(spark, path)
    stream = files.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file; fails if it is already there."""
    files, location = _locate(spark, path)
    stream = files.create(location, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
