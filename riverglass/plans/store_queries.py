"""Queries over the time-series store and the outbox."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.anomaly import backoff_ms
from ..functions.times import DAY_MS
from ..operators import outbox, points
from ..streaming.sinks import delivery_counters, hour_columns, retained
from .tables import MEASURES, SQL, readings

#: The end of the tables' time, 2024-01-31.
NOW_MS = 1_706_659_200_000

#: What a dashboard of the process shows.
DASHBOARD = ("anomaly_score_stream6", "anomaly_score_stream9", "anomaly_score_stream_11", *(f"xmeas_{i}" for i in (1, 2, 8, 6, 9, 10, 12, 13, 15, 16, 17, 19, 20, 21, 22)))


def _long(spark: SparkSession, sf_dir: str, start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
    read = readings(spark, sf_dir, start_ms, end_ms)
    return read.select(F.col("measure").alias("measure_name"), F.col("value").cast("string").alias("measure_value"), F.col("edge_ms").alias("time"))


def _series(name: str, days: int, spark: SparkSession, sf_dir: str) -> DataFrame:
    start = NOW_MS - days * DAY_MS
    found = points.time_series(_long(spark, sf_dir, start, NOW_MS), [name], start, NOW_MS)
    return found.select("measure_name", F.posexplode("series").alias("place", "x")).select("measure_name", "place", "x.time", "x.value")


def dashboard_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of a dashboard's series, in one scan, over measures named as it names them; of a day, as the tables have few readings in 15 minutes."""
    end = NOW_MS - 15 * DAY_MS
    named = F.element_at(F.array(*map(F.lit, DASHBOARD)), (F.col("sequence_number") % len(DASHBOARD) + 1).cast("int"))
    long = readings(spark, sf_dir, end - DAY_MS, end).select(named.alias("measure_name"), F.col("value").cast("string").alias("measure_value"), F.col("edge_ms").alias("time"))
    return points.time_series(long, DASHBOARD, end - DAY_MS, end).select("measure_name", F.size("series").alias("points"), F.round(F.aggregate("series", F.lit(0.0), lambda a, x: a + x["value"]), 6).alias("total"))


def tail_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points.tail(readings(spark, sf_dir).select("sequence_number", "device_id", "props"), "sequence_number", 5)


def highlight_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = readings(spark, sf_dir).select("sequence_number", F.col("score").alias("s6"), (F.col("k") / 40).alias("s9"), (F.col("device_id") % 7 / 3).alias("s11"))
    return scores.select("sequence_number", (F.greatest("s6", "s9", "s11") > 2).alias("highlighted"))


def _outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = readings(spark, sf_dir)
    return read.select(
        F.lpad(F.col("sequence_number").cast("string"), 9, "0").alias("message_id"),
        F.col("props").alias("payload"),
        F.col("edge_ms").alias("original_timestamp_ms"),
        F.col("edge_ms").alias("stored_timestamp_ms"),
        (F.lit(NOW_MS) - F.col("k") * 1000).alias("last_retry_timestamp_ms"),
        (F.col("sequence_number") % 7).cast("int").alias("retry_count"),
        F.when(F.col("sequence_number") % 3 == 0, 1).otherwise(0).alias("priority"),
        F.lit(True).alias("is_persisted"),
    )


def outbox_take(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outbox.take(_outbox(spark, sf_dir), 20, NOW_MS).select("message_id", "priority", "retry_count", "original_timestamp_ms")


def outbox_after_sending(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = _outbox(spark, sf_dir)
    done = held.where("retry_count = 0").select("message_id")
    failed = held.where("retry_count in (1, 4)").select("message_id", (F.col("retry_count") == 1).alias("retry"))
    return outbox.fail(outbox.confirm(held, done), failed, NOW_MS).groupBy("retry_count").agg(F.count("*").alias("messages"), F.max("last_retry_timestamp_ms").alias("last_retry"))


def outbox_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outbox.totals(outbox.expire(outbox.load(_outbox(spark, sf_dir)), NOW_MS)).select("pending", "bytes", F.round("utilisation", 12).alias("utilisation"))


def backoff_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey").alias("retries"), backoff_ms(F.col("n_nationkey")).alias("wait_ms"))


def retention_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = retained(_long(spark, sf_dir, NOW_MS - 7 * DAY_MS), NOW_MS, 7)
    return kept.groupBy("measure_name").agg(F.count("*").alias("points"), F.min("time").alias("oldest"))


def hourly_csv_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _long(spark, sf_dir).withColumns(hour_columns("time"))
    return placed.groupBy(F.concat_ws("/", "year", "month", "day", "hour").alias("prefix")).agg(F.count("*").alias("rows"))


def store_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a notification sink counts, by device: a channel takes nine in ten messages, another all."""
    read = readings(spark, sf_dir).select(F.col("device_id").cast("string").alias("device_id"), F.col("sequence_number").cast("string").alias("alert_id"), "k")
    tried = F.explode(F.array(F.struct(F.lit("Console").alias("channel"), F.lit(True).alias("sent")), F.struct(F.lit("SNS").alias("channel"), (F.col("k") < 90).alias("sent"))))
    ledger = read.select("device_id", "alert_id", tried.alias("x")).select("device_id", "alert_id", "x.channel", "x.sent")
    return delivery_counters(ledger, ["device_id"])


QUERIES = {
    **{f"time_series_{m}": partial(_series, m, 3) for m in MEASURES},
    **{f.__name__: f for f in (dashboard_series, tail_messages, highlight_scores, outbox_take, outbox_after_sending, outbox_expiry, backoff_schedule, retention_filter, hourly_csv_layout, store_counters)},
}

_OUTBOX = f"""{SQL}, b AS (
  SELECT lpad(sequence_number::VARCHAR, 9, '0') AS message_id, props AS payload, edge_ms AS original_timestamp_ms, {NOW_MS} - k * 1000 AS last_retry_timestamp_ms, (sequence_number % 7)::INT AS retry_count,
         CASE WHEN sequence_number % 3 = 0 THEN 1 ELSE 0 END AS priority, {NOW_MS} - edge_ms <= {outbox.EXPIRY_MS} AND sequence_number % 7 < {outbox.MOST_RETRIES} AS alive,
         sequence_number % 7 = 0 OR {NOW_MS} - k * 1000 + least(1000 * power(2, sequence_number % 7), 60000) <= {NOW_MS} AS eligible FROM e
)"""

ORACLES = {
    **{
        f"time_series_{m}": f"""WITH {SQL} SELECT measure AS measure_name, (row_number() OVER (ORDER BY edge_ms, value) - 1)::INT AS place, edge_ms AS time, value FROM e
        WHERE measure = '{m}' AND edge_ms BETWEEN {NOW_MS - 3 * DAY_MS} AND {NOW_MS}"""
        for m in MEASURES
    },
    "dashboard_series": f"""WITH {SQL}, l AS (SELECT list_extract([{", ".join(f"'{n}'" for n in DASHBOARD)}], (sequence_number % {len(DASHBOARD)} + 1)::INT) AS measure_name, value, edge_ms FROM e)
        SELECT measure_name, count(*)::INT AS points, round(sum(value), 6) AS total FROM l WHERE edge_ms BETWEEN {NOW_MS - 16 * DAY_MS} AND {NOW_MS - 15 * DAY_MS} GROUP BY measure_name""",
    "tail_messages": f"""WITH {SQL} SELECT sequence_number, device_id, props FROM e ORDER BY sequence_number DESC LIMIT 5""",
    "highlight_scores": f"""WITH {SQL} SELECT sequence_number, greatest(score, k / 40.0::DOUBLE, device_id % 7 / 3.0::DOUBLE) > 2 AS highlighted FROM e""",
    "outbox_take": f"""WITH {_OUTBOX}, o AS (SELECT *, row_number() OVER (ORDER BY priority DESC, original_timestamp_ms, message_id) AS n FROM b WHERE alive)
        SELECT message_id, priority, retry_count, original_timestamp_ms FROM o WHERE n < coalesce((SELECT min(n) FROM o WHERE NOT eligible), 1000000000) ORDER BY n LIMIT 20""",
    "outbox_after_sending": f"""WITH {_OUTBOX}, f AS (SELECT CASE WHEN retry_count = 1 THEN 2 ELSE retry_count END::INT AS retry_count, CASE WHEN retry_count = 1 THEN {NOW_MS} ELSE last_retry_timestamp_ms END AS seen_ms
        FROM b WHERE retry_count NOT IN (0, 4)) SELECT retry_count, count(*) AS messages, max(seen_ms) AS last_retry FROM f GROUP BY retry_count""",
    "outbox_expiry": f"""WITH {_OUTBOX} SELECT count(*) AS pending, coalesce(sum(strlen(payload)), 0)::BIGINT AS bytes, round(coalesce(sum(strlen(payload)), 0)::DOUBLE / {outbox.MOST_BYTES}, 12) AS utilisation FROM b WHERE alive""",
    "backoff_schedule": "SELECT n_nationkey AS retries, least(1000 * power(2, n_nationkey), 60000)::BIGINT AS wait_ms FROM nation",
    "retention_filter": f"""WITH {SQL} SELECT measure AS measure_name, count(*) AS points, min(edge_ms) AS oldest FROM e WHERE edge_ms >= {NOW_MS - 7 * DAY_MS} GROUP BY measure""",
    "hourly_csv_layout": f"""WITH {SQL} SELECT strftime(ts, '%Y/%m/%d/%H') AS prefix, count(*) AS rows FROM events GROUP BY ALL""",
    "store_counters": f"""WITH {SQL} SELECT device_id::VARCHAR AS device_id, count(*) AS processed, count(*) FILTER (WHERE k < 90) AS sent, count(*) FILTER (WHERE k >= 90) AS failed,
        count(*) + count(*) FILTER (WHERE k < 90) AS deliveries FROM e GROUP BY device_id""",
}
