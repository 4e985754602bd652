"""Where messages and rows come from, as batches and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsing, schemas
from ..operators import quality
from .queue import QueueSource


def json_messages(spark: SparkSession, path: str, streaming: bool = False, files_per_trigger: int = 100) -> DataFrame:
    """JSON lines as text, one message a row; a stream takes so many new files at a time."""
    if streaming:
        return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
    return spark.read.text(path)


def process_csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """A process simulation's CSV, by its fixed schema, so nothing is read to infer one."""
    return spark.read.schema(schemas.CSV_DDL).option("header", header).csv(path)


def stamped(messages: DataFrame, device: str, latency_ms: int = 10) -> DataFrame:
    """Messages with the device's id, the time of receipt, the clock offset and the corrected time."""
    received = F.unix_millis(F.current_timestamp())
    held = messages.withColumn("device_id", F.lit(device)).withColumn("cloud_timestamp_ms", received)
    held = held.withColumn("clock_offset_ms", F.col("cloud_timestamp_ms") - F.col("edge_timestamp_ms") - latency_ms // 2)
    return held.withColumn("corrected_timestamp_ms", F.col("edge_timestamp_ms") + F.col("clock_offset_ms"))


def with_ingestion_time(rows: DataFrame) -> DataFrame:
    """Rows with ingested_ms, when Spark read them: a batch's time, for jobs that go by it."""
    return rows.withColumn("ingested_ms", F.unix_millis(F.current_timestamp()))


def queue_messages(spark: SparkSession, path: str, device: str, most: int = 100, start: str = "newest", latency_ms: int = 10) -> DataFrame:
    """A stream of an edge queue's messages, parsed, numbered by the queue and stamped; excessive drift is noted.

    A checkpoint's number counts before start. Messages without a time have the time of receipt.
    """
    spark.dataSource.register(QueueSource)
    raw = spark.readStream.format("riverglass_queue").option("path", path).option("most", most).option("start", start).load()
    held = with_ingestion_time(raw).withColumn("m", parsing.parse_message(F.col("value"))).where(F.size("m.measurements") > 0)
    edge = F.coalesce("m.edge_timestamp_ms", "ingested_ms").alias("edge_timestamp_ms")
    found = stamped(held.select("sequence_number", "m.idempotency_key", edge, "m.measurements", "ingested_ms"), device, latency_ms)
    return found.withColumn("clock_drift_excessive", quality.excessive_drift(F.col("edge_timestamp_ms"), F.col("clock_offset_ms"), F.col("ingested_ms")))


def kinesis_options(stream: str, region: str, position: str = "LATEST", poll_ms: int = 1000, most: int = 10_000, adaptive: bool = False) -> dict[str, str]:
    """A connector's options. Adaptive reads take what the shards give, so neither a number nor a position is set for them."""
    options = {"kinesis.streamName": stream, "kinesis.region": region, "kinesis.getRecordsIntervalMillis": str(poll_ms)}
    fixed = {"kinesis.startingposition": position, "kinesis.maxRecordsPerFetch": str(most)}
    return options if adaptive else options | fixed


def kinesis_stream(spark: SparkSession, stream: str, region: str, connector: str = "aws-kinesis", **options) -> DataFrame:
    """A cloud stream's records as text, by a connector that registers the format and gives each record's bytes as data.

    options are those of kinesis_options(); a connector is on the class path, or a Python data source.
    """
    found = spark.readStream.format(connector).options(**kinesis_options(stream, region, **options)).load()
    return found.select(F.col("data").cast("string").alias("value"))
