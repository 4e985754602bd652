"""The driver's tables read as the engine's records: a user is a device, an event's type its measure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import between, epoch_ms

#: A score is a value over this; above THRESHOLD it is an anomaly.
SCALE, THRESHOLD = 100.0, 1.0

MEASURES = ("click", "error", "purchase", "signup", "view")

#: The records in SQL.
SQL = """e AS (
  SELECT event_id AS sequence_number, user_id AS device_id, event_type AS measure, epoch_us(ts) // 1000 AS edge_ms, value, value / 100.0::DOUBLE AS score,
         props, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
)"""


def readings(spark: SparkSession, sf_dir: str, start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
    """sequence_number, device_id, measure, edge_ms, value, score, props, k of each event, of a closed time range if given."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    if start_ms is not None or end_ms is not None:
        events = events.where(between("ts", start_ms, end_ms))
    return events.select(
        F.col("event_id").alias("sequence_number"),
        F.col("user_id").alias("device_id"),
        F.col("event_type").alias("measure"),
        epoch_ms("ts").alias("edge_ms"),
        "value",
        (F.col("value") / SCALE).alias("score"),
        "props",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )
