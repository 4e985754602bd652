"""The jobs: edge (flag, score, window) and cloud (accept, score again, alert), from the same steps for batch and stream.

Sequential steps are folds; a stream runs them by ordered(), a batch by fold(), so both give the same rows. In a stream
a row counts once the watermark has passed it, and rows that come later are dropped.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import parsing, schemas
from ..functions.times import duration_ms
from ..operators import alerts, quality, scoring
from ..operators.folds import fold
from ..operators.forest import Forest
from .config import Config
from .processors import TIME, ordered
from .sinks import Batch, Channel, notifications

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

EDGE_ORDER = ("edge_timestamp_ms", "sequence_number")
WINDOW_ORDER = ("window_end_ms", "window_start_ms", "window_key")


def timed(stream: DataFrame, column: str, delay: str) -> DataFrame:
    """A stream with event_time, from milliseconds, and a watermark on it."""
    return stream.withColumn(TIME, F.timestamp_millis(column)).withWatermark(TIME, delay)


def parse(raw: DataFrame) -> DataFrame:
    """JSON text (value) as messages: device, sequence, time, idempotency key and measurements; bad JSON is left out.

    A message without an idempotency key stays, and is nobody's duplicate.
    """
    m = raw.select(parsing.parse_message(F.col("value")).alias("m")).where("m.edge_timestamp_ms is not null")
    return m.select(F.coalesce("m.device_id", F.lit("unknown")).alias("device_id"), "m.sequence_number", "m.edge_timestamp_ms", "m.idempotency_key", "m.measurements")


def vectors(messages: DataFrame, groups: dict[str, range] | None = None) -> DataFrame:
    """A row for each message and group: the group's name and vector, and the message's other columns."""
    names = schemas.group_measures(groups or schemas.SAMPLED_GROUPS)
    entries = F.array(*[F.struct(F.lit(g).alias("group"), parsing.group_vector(F.col("measurements"), m).alias("vector")) for g, m in names.items()])
    rest = [c for c in messages.columns if c != "measurements"]
    return messages.select(*rest, F.explode(entries).alias("g")).select(*rest, "g.group", "g.vector")


def _forest(config: Config) -> Callable[[], Forest]:
    settings = {"trees": config.trees, "size": config.sample_size, "decay": config.decay, "seed": config.seed}
    return lambda: Forest(**settings)


# Edge


def edge_scores_batch(messages: DataFrame, config: Config) -> DataFrame:
    """What edge_scores() gives, for a batch, where keys are never forgotten."""
    flagged = quality.flag_duplicates(messages, ["device_id", "idempotency_key"], EDGE_ORDER)
    split = vectors(flagged).withColumn(TIME, F.timestamp_millis("edge_timestamp_ms"))
    scored = fold(split, ["device_id", "group"], EDGE_ORDER, lambda: None, scoring.score_step(_forest(config)), "score double", ["is_duplicate", "vector"])
    return scored.drop("vector").withColumn("processing_stage", F.lit("EDGE_PREPROCESSED"))


def edge_scores(messages: DataFrame, config: Config) -> DataFrame:
    """A stream of messages, flagged by their keys once a device, then scored by group; duplicates pass unscored."""
    texts = messages.withColumn("measurements", F.to_json("measurements"))  # maps don't go through pandas as they are
    held = timed(texts, "edge_timestamp_ms", config.edge_watermark)
    init, step = quality.seen_step(duration_ms(config.key_ttl), config.bloom_capacity)
    flagged = ordered(held, ["device_id"], EDGE_ORDER, init, step, "is_duplicate boolean")
    split = vectors(flagged.withColumn("measurements", F.from_json("measurements", "map<string,double>")))
    scored = ordered(split, ["device_id", "group"], EDGE_ORDER, lambda: None, scoring.score_step(_forest(config)), "score double")
    return scored.drop("vector").withColumn("processing_stage", F.lit("EDGE_PREPROCESSED"))


def edge_windows(scores: DataFrame, config: Config) -> DataFrame:
    """Per device, group and window, of a batch's or a stream's scores: their count, average, largest and number above the threshold.

    Duplicates don't count. A stream gives a window when the watermark has passed its end.
    """
    held = scores.where("not is_duplicate")
    found = held.groupBy("device_id", "group", F.window(TIME, config.window, config.window, config.window_offset)).agg(
        F.count("score").alias("count"), F.avg("score").alias("avg"), F.max("score").alias("max"), F.count_if(F.col("score") > config.threshold).alias("anomaly_count")
    )
    bounds = [F.unix_millis("window.start").alias("window_start_ms"), F.unix_millis("window.end").alias("window_end_ms")]
    return found.select("device_id", "group", *bounds, "count", "avg", "max", "anomaly_count")


def edge_batch(messages: DataFrame, config: Config) -> DataFrame:
    """The windows of a batch of messages."""
    return edge_windows(edge_scores_batch(messages, config), config)


def late_rows(query: StreamingQuery) -> int:
    """How many rows a stream dropped as they came after the watermark."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])


# Cloud


def windows_of(raw: DataFrame) -> DataFrame:
    """Window records from JSON text (value), envelopes too: device_id, window_key, bounds, idempotency_keys, transaction_id, value."""
    w = raw.select("value", parsing.parse_window(F.col("value")).alias("w")).where("w.window_end_ms is not null and w.device_id is not null")
    key = parsing.window_key(F.col("w.device_id"), F.col("w.window_start_ms"), F.col("w.window_end_ms"), F.col("w.message_count"), F.col("w.message_ids"))
    keys = F.coalesce("w.idempotency_keys", F.expr("cast(array() as array<string>)"))
    transaction = F.get_json_object("value", "$.transaction_id")
    return w.select("w.device_id", key.alias("window_key"), "w.window_start_ms", "w.window_end_ms", keys.alias("idempotency_keys"), transaction.alias("transaction_id"), "value")


def accepted_windows(windows: DataFrame, config: Config) -> DataFrame:
    """A stream of windows_of() without those that were received before, by device."""
    step = quality.accept_step(duration_ms(config.key_ttl), "transaction_id")
    held = timed(windows, "window_end_ms", config.cloud_watermark)
    return ordered(held, ["device_id"], WINDOW_ORDER, dict, step, "accepted boolean").where("accepted").drop("accepted")


def accepted_batch(windows: DataFrame, config: Config) -> DataFrame:
    """What accepted_windows() gives, for a batch."""
    found = fold(windows, ["device_id"], WINDOW_ORDER, dict, quality.accept_step(duration_ms(config.key_ttl), "transaction_id"), "accepted boolean")
    return found.where("accepted").drop("accepted").withColumn(TIME, F.timestamp_millis("window_end_ms"))


def _features(accepted: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    opened = accepted.withColumn("w", parsing.parse_window(F.col("value")))
    fields = [F.col(f"w.{c}").alias(c) for c in ("window_id", "message_count", "aggregated_measurements", "aggregated_anomaly_scores")]
    opened = opened.select("device_id", "window_start_ms", "window_end_ms", TIME, *fields)
    return scoring.group_features(opened, groups, ["device_id", "window_id", "window_start_ms", "window_end_ms", TIME])


def _secondary(config: Config) -> dict[str, float | int]:
    return {"shingle": config.shingle, "base": config.secondary_threshold, "trees": config.cloud_trees, "size_of_sample": config.cloud_sample_size, "decay": config.cloud_decay, "seed": config.seed}


def secondary_scores(accepted: DataFrame, config: Config, groups: dict[str, list[str]] | None = None) -> DataFrame:
    """Second scores and adaptive thresholds of each window and group with edge scores; of a stream or a batch."""
    split = _features(accepted, groups or schemas.group_measures(schemas.SAMPLED_GROUPS))
    init, step = scoring.secondary_step(**_secondary(config))
    keys, order = ["device_id", "group"], ["window_end_ms", "window_start_ms"]
    run = ordered if accepted.isStreaming else fold
    return run(split, keys, order, init, step, scoring.SECONDARY).drop("vector")


def window_alerts(scores: DataFrame, config: Config) -> DataFrame:
    """Alerts from second scores above their thresholds, before suppression; scalars only, as stateful steps follow."""
    held = scores.withColumn("score", F.col("secondary_score")).withColumn("threshold", F.col("adaptive_threshold"))
    found = alerts.raise_alerts(held, "WINDOW_AGGREGATE", "window_end_ms", group="group")
    return _clocked(found, config).select(*_SCALARS, "window_id", "edge_score", TIME)


_SCALARS = ("device_id", "group", "score", "threshold", "ratio", "severity", "alert_id", "alert_type", "timestamp_ms", "clock_ms", "alert_title", "alert_description", "alert_status")


def _clocked(found: DataFrame, config: Config) -> DataFrame:
    """Alerts with clock_ms, the time that suppression and cooldown go by."""
    now = F.unix_millis(F.current_timestamp())
    return found.withColumn("clock_ms", now if config.processing_clock else F.col("timestamp_ms"))


def score_alerts(scores: DataFrame, config: Config, time: str = "edge_timestamp_ms") -> DataFrame:
    """Alerts from edge scores above the threshold, before suppression; scalars only."""
    held = scores.where("score is not null").withColumn("threshold", F.lit(config.secondary_threshold))
    return _clocked(alerts.raise_alerts(held, "SINGLE_POINT", time, group="group"), config).select(*_SCALARS, TIME)


def suppressed(found: DataFrame, config: Config) -> DataFrame:
    """Alerts, of a stream or a batch, without those that follow another of the device too soon."""
    step = alerts.suppress_step(config.near_ms, config.far_ms, "clock_ms")
    run = ordered if found.isStreaming else fold
    return run(found, ["device_id"], ["timestamp_ms", "alert_id"], lambda: None, step, "emitted boolean").where("emitted").drop("emitted")


def cooled(found: DataFrame, config: Config) -> DataFrame:
    """Alerts, of a stream or a batch, that are notified: not within the cooldown of the last of their device, group and severity."""
    step = alerts.cool_step(config.cooldown_ms, "clock_ms")
    run = ordered if found.isStreaming else fold
    return run(found, ["device_id", "group", "severity"], ["timestamp_ms", "alert_id"], lambda: None, step, "notified boolean").where("notified").drop("notified")


def finished(found: DataFrame) -> DataFrame:
    """Alerts with the channels they go to, and, for windows, how the scores compare and which window it was."""
    routed = alerts.routed(found)
    if "edge_score" not in found.columns:
        return routed
    more = scoring.improvement(F.col("score"), F.col("edge_score"), F.col("threshold"))
    return routed.withColumn("metadata", more).withColumn("related_window_ids", F.array("window_id")).drop("edge_score", "window_id")


def cloud_alerts(raw: DataFrame, config: Config, groups: dict[str, list[str]] | None = None) -> DataFrame:
    """The cloud job, of a stream or a batch of JSON windows: accepted, scored again, and told about where it is due."""
    held = windows_of(raw)
    accepted = accepted_windows(held, config) if raw.isStreaming else accepted_batch(held, config)
    return finished(cooled(suppressed(window_alerts(secondary_scores(accepted, config, groups), config), config), config))


# Running


def start(stream: DataFrame, sink: Batch, checkpoint: str, config: Config, once: bool = False) -> StreamingQuery:
    """Run a stream into a sink; the checkpoint keeps offsets and state, the sink replaces a batch that comes again.

    once ends when all that is there is read.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=config.trigger)).start()


def notify(found: DataFrame, channels: Mapping[str, Channel], checkpoint: str, config: Config, ledger: str | None = None, once: bool = False) -> StreamingQuery:
    """Send a stream's alerts to channels, batch_size at a time; the ledger says what became of each."""
    return start(found, notifications(channels, config.batch_size, ledger), checkpoint, config, once)


def supervise(begin: Callable[[], StreamingQuery], attempts: int = 5, delay_s: float = 10.0, sleep: Callable[[float], None] = time.sleep) -> int:
    """Run a query until it ends, and begin it again after a failure, so many times at most; how many failures there were."""
    failures = 0
    while True:
        try:
            begin().awaitTermination()
            return failures
        except Exception:  # noqa: BLE001 - whatever failed, the checkpoint says where to go on
            failures += 1
            if failures > attempts:
                raise
            sleep(delay_s)


def use_rocksdb(spark: SparkSession) -> None:
    """Keep state in RocksDB, which the processors need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
