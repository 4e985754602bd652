"""Long-format time-series points, and series read back from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def points(df: DataFrame, dimensions: Sequence[str], time: str, values: dict[str, tuple[str, Column]]) -> DataFrame:
    """A row for each named value that isn't null: dimensions, measure_name, measure_value_type, measure_value, time.

    values maps a name, or a column that makes one, to the value's type and the value.
    """
    entries = [F.struct(F.lit(n).alias("measure_name"), F.lit(t).alias("measure_value_type"), v.cast("double").alias("measure_value")) for n, (t, v) in values.items()]
    return _exploded(df, dimensions, time, F.array(*entries))


def named_points(df: DataFrame, dimensions: Sequence[str], time: str, prefix: str, values: dict[str, tuple[str, Column]]) -> DataFrame:
    """As points(), each name after the row's own prefix."""
    entries = [F.struct(F.concat_ws("_", prefix, F.lit(n)).alias("measure_name"), F.lit(t).alias("measure_value_type"), v.cast("double").alias("measure_value")) for n, (t, v) in values.items()]
    return _exploded(df, dimensions, time, F.array(*entries))


def _exploded(df: DataFrame, dimensions: Sequence[str], time: str, entries: Column) -> DataFrame:
    long = df.select(*dimensions, F.col(time).alias("time"), F.explode(entries).alias("p"))
    return long.select(*dimensions, "p.measure_name", "p.measure_value_type", "p.measure_value", "time").where("measure_value is not null")


def map_points(df: DataFrame, dimensions: Sequence[str], time: str, values: str) -> DataFrame:
    """A DOUBLE point for each numeric entry of a map of strings; others are left out."""
    long = df.select(*dimensions, F.col(time).alias("time"), F.explode(values).alias("measure_name", "text"))
    long = long.withColumn("measure_value", F.col("text").try_cast("double")).where("measure_value is not null")
    return long.select(*dimensions, "measure_name", F.lit("DOUBLE").alias("measure_value_type"), "measure_value", "time")


def stat_points(stats: DataFrame, dimensions: Sequence[str], time: str, group: str = "measure", with_count: bool = False) -> DataFrame:
    """avg, max, min and stddev of each group's statistics, and their count if asked for."""
    values = {"avg": ("DOUBLE", F.col("avg")), "max": ("DOUBLE", F.col("max")), "min": ("DOUBLE", F.col("min")), "stddev": ("DOUBLE", F.col("std_dev"))}
    if with_count:
        values["count"] = ("BIGINT", F.col("count"))
    return named_points(stats, dimensions, time, group, values)


def score_points(stats: DataFrame, dimensions: Sequence[str], time: str, group: str = "measure", with_ratio: bool = False) -> DataFrame:
    """score_max, score_avg and anomaly_count of each group's scores, and the anomaly ratio if asked for."""
    values = {"score_max": ("DOUBLE", F.col("max")), "score_avg": ("DOUBLE", F.col("avg")), "anomaly_count": ("BIGINT", F.col("anomaly_count"))}
    if with_ratio:
        values["anomaly_ratio"] = ("DOUBLE", F.col("anomaly_ratio"))
    return named_points(stats, dimensions, time, group, values)


def window_points(windows: DataFrame, dimensions: Sequence[str], time: str = "window_end_ms", with_duration: bool = True) -> DataFrame:
    """message_count of each window, and its duration."""
    values = {"message_count": ("BIGINT", F.col("message_count"))}
    if with_duration:
        values["window_duration_ms"] = ("BIGINT", F.col("window_end_ms") - F.col("window_start_ms"))
    return points(windows, dimensions, time, values)


def json_points(rows: DataFrame, numbers: Column, scores: dict[str, Column], dimensions: dict[str, Column], time: str, keep: Sequence[str] = ()) -> DataFrame:
    """A DOUBLE point for each entry of a map of numbers and for each named score, with the same dimensions."""
    added = F.create_map(*[x for name, value in scores.items() for x in (F.lit(name), value.cast("double"))])
    long = rows.select(*keep, *[v.alias(k) for k, v in dimensions.items()], F.col(time).alias("time"), F.explode(F.map_concat(numbers, added)).alias("measure_name", "measure_value"))
    return long.where("measure_value is not null").withColumn("measure_value_type", F.lit("DOUBLE"))


def alert_points(alerts: DataFrame, level: Column, measurements: str = "measurements_involved") -> DataFrame:
    """Score, threshold, severity level and the measurements involved of each alert, with five dimensions."""
    values = {"anomaly_score": ("DOUBLE", F.col("score")), "anomaly_threshold": ("DOUBLE", F.col("threshold")), "severity_level": ("BIGINT", level)}
    dimensions = ["device_id", "alert_id", "alert_type", "severity", "measure"]
    involved = alerts.select(*dimensions, F.col("timestamp_ms").alias("time"), F.explode(measurements).alias("name", "measure_value")).where("measure_value is not null")
    involved = involved.select(*dimensions, F.concat(F.lit("measurement_"), "name").alias("measure_name"), F.lit("DOUBLE").alias("measure_value_type"), "measure_value", "time")
    return points(alerts, dimensions, "timestamp_ms", values).unionByName(involved)


def time_series(long: DataFrame, names: Sequence[str], start_ms: int, end_ms: int) -> DataFrame:
    """Each named measure's (time, value) pairs of a closed time range, in order, as one array; one scan for all names.

    Over a store of points both filters are on its own columns and reach the scan. Where time is computed, cut the
    source by times.between() as well. A dashboard's range is short, which bounds the arrays.
    """
    there = long.where(F.col("measure_name").isin(*names) & F.col("time").between(start_ms, end_ms))
    series = F.array_sort(F.collect_list(F.struct("time", F.col("measure_value").cast("double").alias("value"))))
    return there.groupBy("measure_name").agg(series.alias("series"))


def tail(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    """The last n rows; each task keeps n of its own."""
    return df.orderBy(F.col(order).desc()).limit(n)
