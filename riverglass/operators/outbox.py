"""An offline outbox: messages wait, are taken by priority, confirmed, or retried with back-off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.anomaly import backoff_ms
from ..functions.times import MINUTE_MS

EXPIRY_MS, MOST_RETRIES, MOST_BYTES = 24 * 3_600_000, 5, 1 << 30


def _eligible(now_ms: int) -> Column:
    return (F.col("retry_count") == 0) | (F.col("last_retry_timestamp_ms") + backoff_ms(F.col("retry_count")) <= now_ms)


def _alive(now_ms: int) -> Column:
    return (F.lit(now_ms) - F.col("original_timestamp_ms") <= EXPIRY_MS) & (F.col("retry_count") < MOST_RETRIES)


def take(outbox: DataFrame, n: int, now_ms: int) -> DataFrame:
    """Up to n messages by priority, then age, before the first that is still in back-off.

    Expired and exhausted messages are passed over. Only the n best and the first waiting one are compared: a top-n,
    then a join with one row, so no task sorts the whole outbox.
    """
    alive = outbox.where(_alive(now_ms))
    place = F.struct(-F.col("priority"), F.col("original_timestamp_ms"), F.col("message_id"))
    head = alive.where(~_eligible(now_ms)).agg(F.min(place).alias("head"))
    first = alive.where(_eligible(now_ms)).withColumn("place", place).orderBy("place").limit(n)
    return first.join(F.broadcast(head), F.col("head").isNull() | (F.col("place") < F.col("head"))).drop("place", "head")


def store(outbox: DataFrame, new: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """The outbox with new messages, in order, as long as their payloads fit; the rest is refused."""
    size = F.octet_length("payload").cast("long")
    used = outbox.agg(F.coalesce(F.sum(size), F.lit(0)).alias("used"))
    # bytes of earlier minutes first, then within a minute, so that no task sees all new messages
    timed = new.withColumn("_minute", F.floor(F.col("stored_timestamp_ms") / MINUTE_MS))
    minutes = timed.groupBy("_minute").agg(F.sum(size).alias("_bytes"))
    earlier = F.coalesce(F.sum("_bytes").over(Window.orderBy("_minute").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    minutes = minutes.select(F.col("_minute").alias("_at"), earlier.alias("_earlier"))
    minutes = minutes.join(F.broadcast(used), F.col("used") + F.col("_earlier") < most_bytes)  # one row
    upto = Window.partitionBy("_minute").orderBy("stored_timestamp_ms", "message_id").rowsBetween(Window.unboundedPreceding, -1)
    sized = timed.join(minutes, F.col("_minute") == F.col("_at")).withColumn("_before", F.coalesce(F.sum(size).over(upto), F.lit(0)))
    fits = sized.where(F.col("used") + F.col("_earlier") + F.col("_before") < most_bytes).select(*new.columns)
    return outbox.unionByName(fits)


def confirm(outbox: DataFrame, done: DataFrame) -> DataFrame:
    """The outbox without the messages in done (message_id)."""
    return outbox.join(done.select("message_id").distinct(), "message_id", "left_anti")


def fail(outbox: DataFrame, failed: DataFrame, now_ms: int) -> DataFrame:
    """The outbox after the messages in failed (message_id, retry) could not be sent: a retry more, or gone."""
    marks = failed.groupBy("message_id").agg(F.max("retry").alias("_retry"))
    joined = outbox.join(marks, "message_id", "left").where(F.col("_retry").isNull() | F.col("_retry"))
    again = F.col("_retry").isNotNull()
    return (
        joined.withColumn("retry_count", F.col("retry_count") + again.cast("int"))
        .withColumn("last_retry_timestamp_ms", F.when(again, F.lit(now_ms)).otherwise(F.col("last_retry_timestamp_ms")))
        .select(*outbox.columns)
    )


def expire(outbox: DataFrame, now_ms: int) -> DataFrame:
    """The outbox without expired and exhausted messages."""
    return outbox.where(_alive(now_ms))


def load(messages: DataFrame) -> DataFrame:
    """Stored messages without the corrupt ones: those lacking an id, a payload or a time."""
    return messages.where("message_id is not null and payload is not null and original_timestamp_ms is not null")


def totals(outbox: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """Pending messages, their bytes, and the share of the space that they use."""
    bytes_ = F.coalesce(F.sum(F.octet_length("payload")), F.lit(0))
    return outbox.agg(F.count("*").alias("pending"), bytes_.alias("bytes"), (bytes_ / most_bytes).alias("utilisation"))
