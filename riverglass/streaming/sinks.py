"""Sinks for batches of a stream. A batch's files are replaced, not added to, when it is written again."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Protocol

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.schemas import OUTBOX_DDL
from ..functions.times import DAY_MS
from ..operators import outbox

Batch = Callable[[DataFrame, int], None]


def day_of(ms: str) -> Column:
    """The UTC day of a time, as yyyy-MM-dd."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col(ms) / DAY_MS).cast("int")).cast("string")


def hour_columns(ms: str) -> dict[str, Column]:
    """year, month, day and hour of a time, in UTC, as a layout's folders."""
    day = day_of(ms)
    hour = F.lpad(F.floor(F.pmod(F.col(ms), F.lit(DAY_MS)) / 3_600_000).cast("string"), 2, "0")
    return {"year": F.substring(day, 1, 4), "month": F.substring(day, 6, 2), "day": F.substring(day, 9, 2), "hour": hour}


def retained(points: DataFrame, now_ms: int, days: int, time: str = "time") -> DataFrame:
    """Points of the last days; over a store by day the filter prunes its folders."""
    return points.where(F.col(time) >= now_ms - days * DAY_MS)


def _overwritten(df: DataFrame, path: str, batch: int, by: Sequence[str]) -> None:
    """Replace a batch's own part of a store: batch is the first folder, so other batches stay as they are."""
    df.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/batch={batch}")


def point_store(path: str) -> Batch:
    """Points as Parquet by day and measure name; a batch that comes again replaces itself."""

    def write(df: DataFrame, batch: int) -> None:
        _overwritten(df.withColumn("date", day_of("time")), path, batch, ["date", "measure_name"])

    return write


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """The points of a store, all batches."""
    return spark.read.parquet(path)


def create_store(spark: SparkSession, database: str, table: str) -> None:
    """The store's database and table, if they are not there."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    columns = "device_id STRING, measure_value DOUBLE, measure_value_type STRING, time BIGINT, date STRING, measure_name STRING"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING parquet PARTITIONED BY (date, measure_name)")


def drop_expired(spark: SparkSession, database: str, table: str, before_day: str) -> int:
    """Drop a table's days before one; how many partitions."""
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {database}.{table}").collect()]
    old = [dict(p.split("=", 1) for p in x.split("/")) for x in parts]
    old = [p for p in old if p["date"] < before_day]
    for p in old:
        spec = ", ".join(f"{k}='{v}'" for k, v in p.items())
        spark.sql(f"ALTER TABLE {database}.{table} DROP IF EXISTS PARTITION ({spec})")
    return len(old)


def csv_delivery(path: str, time: str = "time") -> Batch:
    """CSV with a header, by hour."""

    def write(df: DataFrame, batch: int) -> None:
        df.withColumns(hour_columns(time)).write.mode("overwrite").partitionBy("year", "month", "day", "hour").option("header", True).csv(f"{path}/batch={batch}")

    return write


def json_queue(path: str) -> Batch:
    """JSON lines, one object a row."""

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").json(f"{path}/batch={batch}")

    return write


class Channel(Protocol):
    """Something that alerts are sent to."""

    name: str

    def send(self, alert: Row) -> bool: ...


class ConsoleChannel:
    """Prints an alert's title."""

    name = "Console"

    def send(self, alert: Row) -> bool:
        """Print it."""
        print(f"[{alert['severity']}] {alert['alert_title']}: {alert['alert_description']}")
        return True


class ListChannel:
    """Keeps alerts, for tests and for other code to pick up."""

    def __init__(self, name: str):
        self.name, self.alerts = name, []

    def send(self, alert: Row) -> bool:
        """Keep it."""
        self.alerts.append(alert)
        return True


LEDGER = "alert_id string, device_id string, channel string, sent boolean"


def notifications(channels: Mapping[str, Channel], size: int = 10, ledger: str | None = None) -> Batch:
    """Sends each alert to the channels it is routed to, size alerts at a time from the driver, in order of time.

    The driver holds one partition's alerts at once; suppression and cooldown come before. ledger is a folder that gets
    what became of each (LEDGER), a batch that comes again replacing itself. A channel that fails or raises keeps the
    others from nothing.
    """

    def write(df: DataFrame, batch: int) -> None:
        waiting: list[Row] = []
        told: list[tuple] = []
        for alert in df.orderBy("timestamp_ms", "alert_id").toLocalIterator():
            waiting.append(alert)
            if len(waiting) == size:
                told += _send(waiting, channels)
                waiting = []
        told += _send(waiting, channels)
        if ledger:
            df.sparkSession.createDataFrame(told, LEDGER).write.mode("overwrite").parquet(f"{ledger}/batch={batch}")

    return write


def _send(alerts: list[Row], channels: Mapping[str, Channel]) -> list[tuple]:
    """Send alerts; (alert_id, device_id, channel, whether it took it) of each."""
    told = []
    for alert in alerts:
        for name in alert["notification_channels"]:
            if name in channels:
                try:
                    sent = bool(channels[name].send(alert))
                except Exception:  # noqa: BLE001 - a channel's fault is its own
                    sent = False
                told.append((alert["alert_id"], str(alert["device_id"]) if "device_id" in alert else None, name, sent))
    return told


def delivery_counters(ledger: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Alerts processed, sent (all their channels took them) and failed, and deliveries, of a ledger."""
    each = ledger.groupBy(*by, "alert_id").agg(F.bool_and("sent").alias("all"), F.count_if("sent").alias("took"))
    return each.groupBy(*by).agg(F.count("*").alias("processed"), F.count_if("all").alias("sent"), F.count_if(~F.col("all")).alias("failed"), F.sum("took").alias("deliveries"))


def notified(alerts: DataFrame, ledger: DataFrame) -> DataFrame:
    """Alerts with notified_channels, those that took them."""
    took = ledger.where("sent").groupBy(F.col("alert_id").alias("_id")).agg(F.array_sort(F.collect_set("channel")).alias("_took"))
    found = alerts.join(took, F.col("alert_id") == F.col("_id"), "left")
    return found.withColumn("notified_channels", F.coalesce("_took", F.expr("cast(array() as array<string>)"))).drop("_id", "_took")


def routed_batch(*outputs: tuple[Callable[[DataFrame], DataFrame], Batch]) -> Batch:
    """Several outputs of one batch, which is computed once."""

    def write(df: DataFrame, batch: int) -> None:
        df.persist()
        try:
            for view, sink in outputs:
                sink(view(df), batch)
        finally:
            df.unpersist()

    return write


def drain(box: DataFrame, now_ms: int, send: Callable[[Row], bool], n: int = 10) -> DataFrame:
    """Send up to n waiting messages of an outbox; the outbox without those sent, and with a retry more for those not.

    Only the n messages come to the driver.
    """
    spark = box.sparkSession
    sent = [(r["message_id"], bool(send(r))) for r in outbox.take(box, n, now_ms).collect()]
    done = spark.createDataFrame([(m,) for m, ok in sent if ok], "message_id string")
    failed = spark.createDataFrame([(m, True) for m, ok in sent if not ok], "message_id string, retry boolean")
    return outbox.fail(outbox.confirm(box, done), failed, now_ms)


def kept_offline(windows: DataFrame, now_ms: int, urgent: float = 1.5) -> DataFrame:
    """Windows (window_id, window_end_ms, max) that could not be sent, as outbox messages; priority 1 for scores above urgent."""
    return windows.select(
        F.col("window_id").alias("message_id"),
        F.to_json(F.struct(*windows.columns)).alias("payload"),
        F.col("window_end_ms").alias("original_timestamp_ms"),
        F.lit(now_ms).alias("stored_timestamp_ms"),
        F.lit(0).cast("long").alias("last_retry_timestamp_ms"),
        F.lit(0).alias("retry_count"),
        F.when(F.col("max") > urgent, 1).otherwise(0).alias("priority"),
        F.lit(True).alias("is_persisted"),
    )


def send_or_keep(send: Callable[[DataFrame, int], None], keep: Batch, now_ms: Callable[[], int]) -> Batch:
    """A batch's windows are sent; where that fails, whatever the error, they go to the outbox sink instead, and the stream goes on."""

    def write(df: DataFrame, batch: int) -> None:
        try:
            send(df, batch)
        except Exception:  # noqa: BLE001 - a failing write raises errors of many kinds
            keep(kept_offline(df, now_ms()), batch)

    return write


class OutboxStore:
    """An outbox in a shared folder, in versions; the last complete one counts, and the one before is kept for readers."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        files, path = self._fs(), self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        if not files.exists(path(self.path)):
            return []
        names = [x.getPath().getName() for x in files.listStatus(path(self.path))]
        return sorted(int(n[2:]) for n in names if n.startswith("v=") and files.exists(path(f"{self.path}/{n}/_SUCCESS")))

    def load(self) -> DataFrame:
        """The messages that wait, without corrupt ones."""
        found = self._versions()
        if not found:
            return self.spark.createDataFrame([], OUTBOX_DDL)
        return outbox.load(self.spark.read.schema(OUTBOX_DDL).parquet(f"{self.path}/v={found[-1]}"))

    def save(self, box: DataFrame) -> None:
        """Write the next version; older ones than the last go."""
        found = self._versions()
        version = found[-1] + 1 if found else 0
        box.select(*self.load().columns).write.mode("overwrite").parquet(f"{self.path}/v={version}")
        for old in found[:-1]:
            self._fs().delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={old}"), True)

    def keep(self, df: DataFrame, batch: int) -> None:
        """Add a batch's messages, as far as there is space; those that wait already, from a batch that comes again, are not added twice."""
        box = self.load()
        self.save(outbox.store(box, df.join(box, "message_id", "left_anti")))


def replay(store: OutboxStore, send: Callable[[Row], bool], now_ms: Callable[[], int], n: int = 10) -> Batch:
    """Drains an outbox at each batch of any stream, such as one that ticks every five seconds: n messages are sent again."""

    def write(df: DataFrame, batch: int) -> None:
        now = now_ms()
        store.save(drain(outbox.expire(store.load(), now), now, send, n))

    return write
