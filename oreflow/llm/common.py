"""Helpers the corpus operators share: a shared work folder, and batches for Python stages."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share.

    Only a local session may leave the setting unset; it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/oreflow-llm/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the work folder and read back: its lineage ends there."""
    path = work_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blank_text(text: str) -> F.Column:
    """The text column as a string, a null as the empty text."""
    return F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))


def quoted(name: str) -> str:
    """A column name that may hold dots or back quotes."""
    return "`" + name.replace("`", "``") + "`"


def packed_rows(docs: DataFrame, text: str, id: str | None = None) -> DataFrame:
    """``text``, ``id`` and all other columns in the struct ``whole``: no name can clash."""
    others = [F.col(quoted(c)) for c in docs.columns if c != text]
    columns = [F.struct(F.lit(True).alias("\u0001row"), *others).alias("whole")]
    if id is not None:
        columns.append(F.col(quoted(id)).alias("id"))
    return docs.select(*columns, F.col(quoted(text)).alias("text"))


def unpacked_rows(rows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` from rows that ``packed_rows`` has packed."""
    return rows.select(
        *[F.col("text" if c == text else f"whole.{quoted(c)}").alias(c) for c in docs.columns]
    )


def with_fields(schema: T.StructType, fields: list[tuple[str, str]]) -> T.StructType:
    """``schema`` followed by new fields; fields of the same name (in any case) give way."""
    new = {name.lower() for name, _ in fields}
    kept = [f for f in schema.fields if f.name.lower() not in new]
    added = [T.StructField(name, T._parse_datatype_string(kind)) for name, kind in fields]
    return T.StructType(kept + added)


def with_arrays(batch: pa.RecordBatch, schema: pa.Schema, arrays: dict) -> pa.RecordBatch:
    """``batch`` in the order of ``schema``, with the given arrays for the new columns."""
    columns = [
        arrays[f.name] if f.name in arrays else batch.column(batch.schema.get_field_index(f.name))
        for f in schema
    ]
    columns = [
        c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
        for c, f in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    """The Arrow schema of a Spark schema."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def slices_of(batch: pa.RecordBatch, text: int, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each, or a single row of more."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(text)), 0).cast(pa.int64())).to_numpy()
    begin, before = 0, 0
    while begin < len(ends):
        end = max(begin + 1, int(ends.searchsorted(before + most, "right")))
        yield batch.slice(begin, end - begin)
        begin, before = end, int(ends[end - 1])


def runs_of(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Regroup sorted batches, so that all rows of one value of ``column`` are in one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        last = values[-1]
        if held and held[-1].column(column)[0] == last:
            held.append(batch)
            continue
        cut = _first_of_last(values)
        if cut:
            held.append(batch.slice(0, cut))
            yield _joined(held)
            held = [batch.slice(cut)]
        else:
            if held:
                yield _joined(held)
            held = [batch]
    if held:
        yield _joined(held)


def _first_of_last(values: pa.Array) -> int:
    """Where the run of the last value begins; the values are sorted."""
    low, high, last = 0, len(values) - 1, values[-1]
    while low < high:
        middle = (low + high) // 2
        if values[middle] == last:
            high = middle
        else:
            low = middle + 1
    return low


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
