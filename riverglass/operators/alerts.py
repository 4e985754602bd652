"""Alerts: raised from scores, suppressed, cooled down, batched, routed and told."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.anomaly import CRITICAL, MEDIUM, severity, severity_level
from .folds import Step, fold

#: A channel and the least severity level that it takes.
CHANNELS = {"Console": 1, "Log": 1, "CloudWatch": 1, "SNS": 2}


def raise_alerts(
    scores: DataFrame, alert_type: str, time: str, group: str = "measure", score: str = "score", threshold: str = "threshold",
    message_ids: Column | None = None, window_ids: Column | None = None, measurements: Column | None = None,
) -> DataFrame:
    """Add an alert's fields to the rows whose score is above their threshold: new, and acknowledged by nobody."""
    ratio = F.col(score) / F.col(threshold)
    device = F.col("device_id").cast("string")
    alerts = scores.where(F.col(score) > F.col(threshold)).withColumn("ratio", ratio).withColumn("severity", severity(ratio))
    text = "Anomaly score %.2f exceeds threshold %.2f (%.2fx). Group: %s, Device: %s"
    none = F.expr("cast(array() as array<string>)")
    return alerts.withColumns(
        {
            "alert_id": F.sha2(F.concat_ws("|", F.lit(alert_type), device, F.col(group), F.col(time).cast("string")), 256),
            "alert_type": F.lit(alert_type),
            "timestamp_ms": F.col(time),
            "alert_title": F.format_string("%s Anomaly Detected on %s - %s", severity(ratio), device, F.col(group)),
            "alert_description": F.format_string(text, F.col(score), F.col(threshold), ratio, F.col(group), device),
            "alert_status": F.lit("NEW"),
            "related_message_ids": none if message_ids is None else message_ids,
            "related_window_ids": none if window_ids is None else window_ids,
            "measurements_involved": F.expr("cast(map() as map<string,double>)") if measurements is None else measurements,
            "is_acknowledged": F.lit(False),
            "acknowledged_by": F.lit(None).cast("string"),
            "acknowledged_timestamp_ms": F.lit(None).cast("long"),
        }
    )


def acknowledge(alerts: DataFrame, done: DataFrame) -> DataFrame:
    """Alerts after those in done (alert_id, by, at_ms) were acknowledged; the first to do so counts."""
    first = done.groupBy(F.col("alert_id").alias("_id")).agg(F.min(F.struct("at_ms", "by")).alias("_done"))
    found = alerts.join(first, F.col("alert_id") == F.col("_id"), "left")
    new = F.col("_done").isNotNull() & ~F.col("is_acknowledged")
    return found.withColumns(
        {
            "acknowledged_by": F.when(new, F.col("_done.by")).otherwise(F.col("acknowledged_by")),
            "acknowledged_timestamp_ms": F.when(new, F.col("_done.at_ms")).otherwise(F.col("acknowledged_timestamp_ms")),
            "alert_status": F.when(new, F.lit("ACKNOWLEDGED")).otherwise(F.col("alert_status")),
            "is_acknowledged": F.col("is_acknowledged") | new,
        }
    ).select(*alerts.columns)


def suppress_step(near_ms: int, far_ms: int, time: str = "timestamp_ms") -> Step:
    """A fold over alerts (time, ratio) that tells whether one is emitted.

    It isn't within near_ms of the last emitted one unless critical, nor within far_ms unless medium.
    """

    def step(last: int | None, row: dict[str, Any]) -> tuple[int | None, dict[str, Any]]:
        gap = None if last is None else row[time] - last
        held = gap is not None and (gap < near_ms and row["ratio"] < CRITICAL or gap < far_ms and row["ratio"] < MEDIUM)
        return (last if held else row[time]), {"emitted": not held}

    return step


def suppress(alerts: DataFrame, near_ms: int = 60_000, far_ms: int = 300_000, key: Sequence[str] = ("device_id",), time: str = "timestamp_ms", tie: Sequence[str] = ("sequence_number",)) -> DataFrame:
    """Add emitted, by suppress_step()."""
    return fold(alerts, key, [time, *tie], lambda: None, suppress_step(near_ms, far_ms, time), "emitted boolean", [time, "ratio"])


def cool_step(cooldown_ms: int, time: str = "timestamp_ms") -> Step:
    """A fold over alerts (time, severity) that tells whether one is notified: not within cooldown_ms of the last, unless critical."""

    def step(last: int | None, row: dict[str, Any]) -> tuple[int | None, dict[str, Any]]:
        held = last is not None and row[time] - last < cooldown_ms and row["severity"] != "CRITICAL"
        return (last if held else row[time]), {"notified": not held}

    return step


def cool_down(alerts: DataFrame, cooldown_ms: int = 60_000, key: Sequence[str] = ("device_id", "measure", "severity"), time: str = "timestamp_ms", tie: Sequence[str] = ("sequence_number",)) -> DataFrame:
    """Add notified, by cool_step()."""
    return fold(alerts, key, [time, *tie], lambda: None, cool_step(cooldown_ms, time), "notified boolean", [time, "severity"])


def batches(alerts: DataFrame, size: int = 10, every_ms: int = 5000, time: str = "timestamp_ms", tie: str = "sequence_number") -> DataFrame:
    """Add flush (the interval an alert is sent in) and batch (of size alerts at most within it)."""
    slot = F.floor(F.col(time) / every_ms)
    place = F.row_number().over(Window.partitionBy("flush").orderBy(time, tie)) - 1
    return alerts.withColumn("flush", slot).withColumn("batch", F.floor(place / size))


def routed(alerts: DataFrame) -> DataFrame:
    """Add notification_channels: those that take the alert's severity."""
    level = severity_level(F.col("severity"))
    names = F.array(*[F.when(level >= least, F.lit(name)) for name, least in CHANNELS.items()])
    return alerts.withColumn("notification_channels", F.array_compact(names))


def metric_data(alerts: DataFrame) -> DataFrame:
    """Two rows an alert: AnomalyScore and AlertCount, with the alert's device, group and severity."""
    data = F.array(F.struct(F.lit("AnomalyScore").alias("metric"), F.col("score").alias("value")), F.struct(F.lit("AlertCount").alias("metric"), F.lit(1.0).alias("value")))
    return alerts.select("alert_id", "device_id", "measure", "severity", F.explode(data).alias("m")).select("alert_id", "device_id", "measure", "severity", "m.metric", "m.value")


def message_body(measurements: Column, metadata: Column) -> Column:
    """A message's text: measurements by name with four decimals, then metadata."""

    def lines(entries: Column, form: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(F.map_entries(entries)), lambda e: form(e)), "\n")

    numbers = lines(measurements, lambda e: F.format_string("  %s: %.4f", e["key"], e["value"]))
    others = lines(metadata, lambda e: F.format_string("  %s: %s", e["key"], e["value"]))
    return F.concat(F.lit("Measurements:\n"), numbers, F.lit("\nMetadata:\n"), others)
