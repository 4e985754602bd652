"""Statistics of windows and rolling samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def measurement_stats(readings: DataFrame, keys: Sequence[str], order: Sequence[str] = ("edge_ms", "sequence_number"), value: str = "value") -> DataFrame:
    """Per key: count, sum, min, max, avg, variance, std_dev, first and last of the values that aren't null, in order.

    The variance is the streaming one: the mean of each value's squared distance from the mean so far. The running
    mean and the aggregate share one exchange by the keys.
    """
    running = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    there = readings.where(F.col(value).isNotNull())
    there = there.withColumn("_gap", F.pow(F.col(value) - F.avg(value).over(running), F.lit(2.0)))
    at = F.struct(*order)
    found = there.groupBy(*keys).agg(
        F.count("*").alias("count"),
        F.sum(value).alias("sum"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.avg(value).alias("avg"),
        F.avg("_gap").alias("variance"),
        F.min_by(value, at).alias("first"),
        F.max_by(value, at).alias("last"),
    )
    return found.withColumn("std_dev", F.sqrt("variance"))


def score_stats(scores: DataFrame, keys: Sequence[str], threshold: float = 1.0, score: str = "score", time: str = "edge_ms", tie: str = "sequence_number") -> DataFrame:
    """Per key: count, sum, min, max, avg, time of the first largest score, scores above the threshold and their share."""
    first_top = F.min_by(time, F.struct(-F.col(score), F.col(time), F.col(tie)))
    found = scores.groupBy(*keys).agg(
        F.count(score).alias("count"),
        F.sum(score).alias("sum"),
        F.min(score).alias("min"),
        F.max(score).alias("max"),
        F.avg(score).alias("avg"),
        first_top.alias("max_timestamp_ms"),
        F.count_if(F.col(score) > threshold).alias("anomaly_count"),
    )
    return found.withColumn("threshold", F.lit(threshold)).withColumn("anomaly_ratio", F.when(F.col("count") > 0, F.col("anomaly_count") / F.col("count")).otherwise(0.0))


def collected_ids(rows: DataFrame, by: Sequence[str], order: Sequence[str], /, **ids: str) -> DataFrame:
    """Per key: message_count and arrays of ids in order."""
    listed = [_listed(order, c).alias(name) for name, c in ids.items()]
    return rows.groupBy(*by).agg(F.count("*").alias("message_count"), *listed)


def _listed(order: Sequence[str], column: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], F.col(column).alias("x")))), lambda s: s["x"])


def rolling_offsets(samples: DataFrame, keys: Sequence[str], order: str, offset: str = "offset_ms", size: int = 100, ready: int = 10, limit: int = 5000) -> DataFrame:
    """Add the clock offset by a key's last size samples: median_ms, std_ms, estimate_ms, initialised, exceeded, exceed_count.

    The median of an even number is the whole mean of the middle two. The estimate is the mean, cut to a whole
    number, of the samples within two standard deviations of the median; it is null until ready samples are there.
    A sample that is over limit away from the estimate counts as exceeded.
    """
    by = Window.partitionBy(*keys).orderBy(order)
    last = by.rowsBetween(-(size - 1), 0)
    held = samples.withColumn("_all", F.sort_array(F.collect_list(offset).over(last))).withColumn("std_ms", F.stddev_pop(offset).over(last))
    n = F.size("_all")
    middle = F.get("_all", F.floor(n / 2).cast("int"))
    below = F.get("_all", F.floor((n - 1) / 2).cast("int"))
    held = held.withColumn("median_ms", F.when(n % 2 == 1, middle).otherwise(_div(below + middle, 2)))
    kept = F.filter("_all", lambda x: F.abs(x - F.col("median_ms")) <= 2 * F.col("std_ms"))
    held = held.withColumn("_kept", kept)
    mean = F.aggregate("_kept", F.lit(0).cast("long"), lambda a, x: a + x) / F.size("_kept")
    held = held.withColumn("samples", n).withColumn("initialised", n >= ready)
    held = held.withColumn("estimate_ms", F.when(F.col("initialised") & (F.size("_kept") > 0), mean.cast("long")))
    exceeded = F.coalesce(F.abs(F.col(offset) - F.col("estimate_ms")) > limit, F.lit(False))
    held = held.withColumn("exceeded", exceeded).withColumn("exceed_count", F.sum(F.col("exceeded").cast("long")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return held.drop("_all", "_kept")


def _div(a: Column, b: int) -> Column:
    """Whole division that cuts towards zero."""
    return (a / b).cast("long")


def with_resets(df: DataFrame, keys: Sequence[str], order: str, reset: Column, into: str = "epoch") -> DataFrame:
    """Add how many resets a key has had up to a row; a key and its epoch are a key that starts anew at a reset."""
    so_far = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(into, F.count_if(reset).over(so_far))


def index_quantile(df: DataFrame, keys: Sequence[str], value: str, share: float = 0.99) -> DataFrame:
    """Per key, the value at place floor(n * share) of its sorted values, and n.

    Rows are counted by ranges of the value, which rise with it; only the rows of the range with the place are ranked,
    so no task sorts all of a key.
    """
    v = F.col(value).cast("double")
    span = (F.signum(v) * F.floor(F.log1p(F.abs(v)) * 1024)).cast("long")
    there = df.where(F.col(value).isNotNull()).withColumn("_span", span)
    counts = there.groupBy(*keys, "_span").agg(F.count("*").alias("_rows"))
    by = Window.partitionBy(*keys)
    counts = counts.withColumn("n", F.sum("_rows").over(by)).withColumn("_upto", F.sum("_rows").over(by.orderBy("_span").rowsBetween(Window.unboundedPreceding, 0)))
    counts = counts.withColumn("_place", F.floor(F.col("n") * F.lit(share)) - (F.col("_upto") - F.col("_rows")))
    last = counts.where("_place >= 0 AND _place < _rows").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_span").alias("_at"), "n", "_place")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_span") == F.col("_at")]
    ranked = there.join(last, same).withColumn("_rank", F.row_number().over(by.orderBy(value)) - 1)
    return ranked.where("_rank = _place").select(*keys, "n", F.col(value).alias("quantile"))


def window_records(rows: DataFrame, keys: Sequence[str], order: Sequence[str], group: str, message_id: str, key: str, threshold: float = 1.0) -> DataFrame:
    """Windows as records: keys, message_count, aggregated_measurements and aggregated_anomaly_scores (maps by group), message_ids, idempotency_keys.

    rows has value and score; a map has one entry for each of a window's groups.
    """

    def folded(found: DataFrame, into: str) -> DataFrame:
        rest = [c for c in found.columns if c not in (*keys, group)]
        entries = F.array_sort(F.collect_list(F.struct(F.col(group).alias("key"), F.struct(*rest).alias("value"))))
        return found.groupBy(*keys).agg(F.map_from_entries(entries).alias(into))

    measured = folded(measurement_stats(rows, [*keys, group], order), "aggregated_measurements")
    scored = folded(score_stats(rows, [*keys, group], threshold, time=order[0], tie=order[1]), "aggregated_anomaly_scores")
    return collected_ids(rows, keys, order, message_ids=message_id, idempotency_keys=key).join(measured, [*keys], "left").join(scored, [*keys], "left")


def running_rate(windows: DataFrame, keys: Sequence[str], order: str, anomalies: str, groups: str) -> DataFrame:
    """Add global_anomaly_rate: the mean so far of anomalies / groups, 0 for a window without groups; windows and alerts so far."""
    so_far = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rate = F.when(F.col(groups) > 0, F.col(anomalies) / F.col(groups)).otherwise(0.0)
    return (
        windows.withColumn("global_anomaly_rate", F.avg(rate).over(so_far))
        .withColumn("total_windows_processed", F.count("*").over(so_far))
        .withColumn("total_alerts_generated", F.sum(anomalies).over(so_far))
    )
