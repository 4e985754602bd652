"""Sensor messages made on the executors, the same for the same seed: normal, anomalous, repeated, late, drifting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MEASURES = 41
START_MS = 1_704_067_200_000
STEP_MS = 100


def _uniform(seed: int, *of: Column) -> Column:
    """0 to 1, by a hash."""
    return F.pmod(F.xxhash64(F.lit(seed), *of), F.lit(1 << 30)) / F.lit(float(1 << 30))


def messages(spark: SparkSession, n: int, devices: int = 1, anomalies: float = 0.0, seed: int = 42, start_ms: int = START_MS) -> DataFrame:
    """n messages a device: message_id, idempotency_key, sequence_number, device_id, edge_timestamp_ms, measurements, is_anomaly.

    A measure has a base of 10 to 100 and a range of 1 to 6, and varies by half its range; in an anomalous message
    three in ten measures are 3 to 8 ranges above their base.
    """
    rows = spark.range(n * devices).select((F.col("id") % devices).alias("d"), F.floor(F.col("id") / devices).alias("s"))
    rows = rows.withColumn("is_anomaly", _uniform(seed + 1, F.col("d"), F.col("s")) < anomalies)

    def value(i: int) -> Column:
        m = F.lit(i)
        base, width = 10 + _uniform(seed + 2, m) * 90, 1 + _uniform(seed + 3, m) * 5
        noise = (_uniform(seed + 4, m, F.col("d"), F.col("s")) - 0.5) * width
        spiked = F.col("is_anomaly") & (_uniform(seed + 5, m, F.col("d"), F.col("s")) < 0.3)
        return base + F.when(spiked, width * (3 + _uniform(seed + 6, m, F.col("d"), F.col("s")) * 5)).otherwise(noise)

    measured = F.map_from_arrays(F.array(*[F.lit(f"xmeas_{i}") for i in range(1, MEASURES + 1)]), F.array(*[value(i) for i in range(1, MEASURES + 1)]))
    device = F.concat(F.lit("device-"), F.col("d"))
    return rows.select(
        F.concat_ws("-", device, "s", F.lit("m")).alias("message_id"),
        F.concat_ws("-", device, "s").alias("idempotency_key"),
        F.col("s").alias("sequence_number"),
        device.alias("device_id"),
        (F.lit(start_ms) + (F.col("s") + 1) * STEP_MS).alias("edge_timestamp_ms"),
        measured.alias("measurements"),
        "is_anomaly",
    )


def _renamed(df: DataFrame, mark: str) -> DataFrame:
    return df.withColumn("message_id", F.concat_ws("-", "message_id", F.lit(mark)))


def duplicates(df: DataFrame, every: int) -> DataFrame:
    """Every so many messages once more: all the same but for the message id."""
    return _renamed(df.where(F.col("sequence_number") % every == 0), "again")


def out_of_order(df: DataFrame, every: int, by_ms: int) -> DataFrame:
    """Every so many messages as new ones with an earlier time."""
    late = _renamed(df.where(F.col("sequence_number") % every == 0), "late")
    return late.withColumn("edge_timestamp_ms", F.col("edge_timestamp_ms") - by_ms).withColumn("idempotency_key", F.col("message_id"))


def drifting(df: DataFrame, by_ms: int) -> DataFrame:
    """All messages with their clock ahead."""
    return df.withColumn("edge_timestamp_ms", F.col("edge_timestamp_ms") + by_ms)


def raw_json(df: DataFrame) -> DataFrame:
    """Messages as flat JSON objects of their measures, as a sensor sends them."""
    return df.select(F.to_json("measurements").alias("value"))
