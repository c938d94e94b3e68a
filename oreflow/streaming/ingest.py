"""JSON messages to a bronze Parquet table with Structured Streaming.

Each micro-batch goes into its own folder, ``stream_id=<query>/batch_id=<n>``, and
replaces it. Spark gives a batch that is replayed after a failure the same number, so it
overwrites itself and no message is stored twice. The stream id is the query's, which
lives in the checkpoint: a query begun anew with another checkpoint counts its batches
from 0 again, and must not overwrite the old ones. With ``day_of`` a level for the day of the
message lies above these two, so a read of some days opens only their folders.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from oreflow.operators.cleaning import AddAuditColumns, Step, TrimStrings, compose
from oreflow.sources.paths import zone_path
from oreflow.sources.readers import read_csv
from oreflow.sources.schemas import RAW_ORDERS_SCHEMA
from oreflow.sources.snapshots import SnapshotTable

# How much one trigger reads at most, and how often it fires.
MAX_OFFSETS_PER_TRIGGER = 100_000
DEFAULT_TRIGGER = "30 seconds"

#: The folder level of a message's day.
DAY = "ingest_date"

MESSAGE_SCHEMA = "value binary, offset long, partition int, timestamp timestamp"


def kafka_source(
    spark: SparkSession,
    servers: str,
    topic: str,
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER,
    **options: str,
) -> DataFrame:
    """Messages of a Kafka topic. Needs Spark's Kafka connector on the classpath.

    Offsets that are gone fail the query unless ``fail_on_data_loss`` is switched off.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .options(**options)
        .load()
    )


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Messages of the same shape from Parquet files as they arrive in a folder."""
    return (
        spark.readStream.schema(MESSAGE_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(path)
    )


def parse_messages(messages: DataFrame, schema: T.StructType = RAW_ORDERS_SCHEMA) -> DataFrame:
    """Message coordinates and the fields of the JSON payload; works on batch and stream.

    A payload that is not JSON gives a row whose fields are all NULL.
    """
    payload = F.from_json(F.col("value").cast("string"), schema).alias("data")
    return messages.select(
        "offset", "partition", F.col("timestamp").alias("kafka_ts"), payload
    ).select("offset", "partition", "kafka_ts", "data.*", F.col("kafka_ts").alias("_ingestion_ts"))


#: The column of a rejected message's or line's own text.
REJECTED = "rejected_text"
_CORRUPT = "_corrupt_record"


def parse_or_reject(messages: DataFrame, schema: T.StructType = RAW_ORDERS_SCHEMA) -> DataFrame:
    """``parse_messages`` with ``rejected_text``: the payload, if it is not an object of the schema.

    A missing payload is rejected as the empty text. Each payload is parsed once.
    """
    full = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = messages.select(
        "offset",
        "partition",
        F.col("timestamp").alias("kafka_ts"),
        text.alias("text"),
        F.from_json(text, full, options).alias("data"),
    )
    bad = F.when(F.col("data").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.col(f"data.{_CORRUPT}"))
    fields = [F.col("data").getField(f.name).alias(f.name) for f in schema]
    stamp = F.col("kafka_ts").alias("_ingestion_ts")
    return parsed.select("offset", "partition", "kafka_ts", *fields, stamp, bad.alias(REJECTED))


def read_csv_or_reject(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """``read_csv`` with ``rejected_text``: the line, if a field of it does not fit the schema."""
    full = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    return read_csv(spark, path, full, mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED, **options)


def write_split(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Rows with ``rejected_text`` to ``<path>/rejected=true``, others to ``rejected=false``, in one job."""
    split = rows.withColumn("rejected", F.col(REJECTED).isNotNull())
    split.write.mode(mode).partitionBy("rejected").parquet(path)


def trigger_options(trigger: str) -> dict[str, object]:
    """``availableNow`` or ``once`` drain what is there and stop; else an interval."""
    if trigger.lower() in ("once", "availablenow"):
        return {"availableNow": True}
    return {"processingTime": trigger}


def stream_of(batch: DataFrame) -> str:
    """The id of the streaming query that hands over ``batch``."""
    return str(batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"))


def batch_writer(
    target: str, transform: Step, day_of: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Write each batch to its own folder, or with ``day_of``, a timestamp of the message, to
    one folder in each day's."""

    def write(batch: DataFrame, batch_id: int) -> None:
        stream, rows = stream_of(batch), batch.transform(transform)
        if day_of is None:
            folder = f"{target}/stream_id={stream}/batch_id={batch_id}"
            rows.write.mode("overwrite").parquet(folder)
            return
        levels = {DAY: F.to_date(day_of), "stream_id": F.lit(stream), "batch_id": F.lit(batch_id)}
        out = rows.withColumns(levels).write.mode("overwrite").partitionBy(*levels)
        out.option("partitionOverwriteMode", "dynamic").parquet(target)

    return write


def upsert_writer(
    table: SnapshotTable, keys: list[str], transform: Step, **options: object
) -> Callable[[DataFrame, int], None]:
    """Merge each batch into a versioned table. The table keeps the number of a stream's last
    batch with the version that holds it, so a batch that is given again changes nothing.
    ``transform`` must leave one row per key."""

    def write(batch: DataFrame, batch_id: int) -> None:
        once = (stream_of(batch), batch_id)
        table.upsert(batch.transform(transform), keys, batch=once, **options)

    return write


@dataclass
class StreamIngest:
    """A streaming ingest of one dataset into bronze."""

    base: str
    checkpoint: str
    dataset: str = "orders"
    schema: T.StructType = field(default_factory=lambda: RAW_ORDERS_SCHEMA)
    env: str = "dev"
    trigger: str = DEFAULT_TRIGGER
    #: A timestamp of the message whose day becomes a folder level, such as ``_ingestion_ts``.
    day_of: str | None = None
    query: StreamingQuery | None = None

    @property
    def target(self) -> str:
        return zone_path(self.base, "bronze", self.dataset)

    def start(self, messages: DataFrame, await_termination: bool = True) -> StreamingQuery:
        """Run the ingest on a stream of messages; resumes from the checkpoint if any."""
        name = f"{self.dataset}_streaming"
        clean = compose(TrimStrings(), AddAuditColumns(name, self.env))
        self.query = (
            parse_messages(messages, self.schema)
            .writeStream.foreachBatch(batch_writer(self.target, clean, self.day_of))
            .option("checkpointLocation", f"{self.checkpoint.rstrip('/')}/{name}")
            .trigger(**trigger_options(self.trigger))
            .start()
        )
        if await_termination:
            self.query.awaitTermination()
        return self.query

    def stop(self) -> None:
        if self.query is not None:
            self.query.stop()
