"""Queries over alerts: severity, text, suppression, cooldown, batches, routing, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.anomaly import severity, severity_level
from ..functions.parsing import window_id
from ..functions.times import DAY_MS, HOUR_MS
from ..operators import alerts, points, stats
from .tables import SQL, THRESHOLD, readings
from .window_queries import _DAILY, KEYS, WINDOW, daily, rounded

#: An alert's threshold here, low enough for all severities.
LOW = 0.5


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = readings(spark, sf_dir).withColumn("threshold", F.lit(LOW))
    ids, values = F.array(F.col("sequence_number").cast("string")), F.create_map("measure", "value")
    return alerts.raise_alerts(held, "SINGLE_POINT", "edge_ms", message_ids=ids, measurements=values)


def severity_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = readings(spark, sf_dir).withColumn("severity", severity(F.col("score") / LOW))
    return named.select("sequence_number", "severity", severity_level(F.col("severity")).alias("level"))


def alert_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    # whole numbers, so that no second decimal is a rounding of a half
    whole = readings(spark, sf_dir).withColumn("score", F.floor("value").cast("double")).withColumn("threshold", F.lit(50.0))
    return alerts.raise_alerts(whole, "SINGLE_POINT", "edge_ms").select("sequence_number", "alert_title", "alert_description")


def alerts_from_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    involved = F.element_at("measurements_involved", F.col("measure"))
    found = _alerts(spark, sf_dir).select(
        "alert_id", "device_id", "sequence_number", "alert_type", "severity", "timestamp_ms", "measure", "score", "threshold", "alert_status", "is_acknowledged",
        F.array_join(F.map_keys("measurements_involved"), ",").alias("measures"), involved.alias("involved"), F.array_join("related_message_ids", ",").alias("related"),
    )
    return rounded(found, "score", "involved")


def acknowledged_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of which some were acknowledged, some twice."""
    held = _alerts(spark, sf_dir)
    once = held.where("k < 20").select("alert_id", F.lit("first").alias("by"), (F.col("timestamp_ms") + 60_000).alias("at_ms"))
    again = held.where("k < 10").select("alert_id", F.lit("second").alias("by"), (F.col("timestamp_ms") + 30_000).alias("at_ms"))
    found = alerts.acknowledge(held, once.unionByName(again))
    return found.select("sequence_number", "is_acknowledged", F.coalesce("acknowledged_by", F.lit("")).alias("by"), F.coalesce("acknowledged_timestamp_ms", F.lit(0)).alias("at_ms"), "alert_status")


def alerts_from_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = daily(spark, sf_dir)
    scored = stats.score_stats(held, KEYS, THRESHOLD).withColumn("score", F.col("max"))
    ids = stats.collected_ids(held.withColumn("id", F.col("sequence_number").cast("string")), WINDOW, ["edge_ms", "sequence_number"], ids="id")
    windowed = scored.join(ids, WINDOW).withColumn("window_id", window_id(*map(F.col, WINDOW)))
    found = alerts.raise_alerts(windowed, "WINDOW_AGGREGATE", "max_timestamp_ms", message_ids=F.col("ids"), window_ids=F.array("window_id"))
    related = [F.array_join("related_message_ids", ",").alias("messages"), F.array_join("related_window_ids", ",").alias("windows"), F.size("measurements_involved").alias("involved")]
    return rounded(found.select("alert_id", "device_id", "measure", "window_start_ms", "severity", "timestamp_ms", "score", "alert_type", *related), "score")


def alert_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.suppress(_alerts(spark, sf_dir).select("device_id", "sequence_number", "timestamp_ms", "ratio"), DAY_MS, 5 * DAY_MS)
    return found.where("emitted").select("device_id", "sequence_number")


def sink_cooldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.cool_down(_alerts(spark, sf_dir).select("device_id", "measure", "severity", "sequence_number", "timestamp_ms"), 3 * DAY_MS)
    return found.select("device_id", "measure", "severity", "sequence_number", "notified")


def alert_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.batches(_alerts(spark, sf_dir), 10, 12 * HOUR_MS)
    return found.groupBy("flush", "batch").agg(F.count("*").alias("alerts"), F.min("sequence_number").alias("first"))


def alert_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = alerts.routed(_alerts(spark, sf_dir))
    return routed.select("sequence_number", "severity", F.array_join("notification_channels", ",").alias("channels"))


def alert_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(alerts.metric_data(_alerts(spark, sf_dir)).drop("alert_id"), "value")


def alert_points_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _alerts(spark, sf_dir)
    return rounded(points.alert_points(found, severity_level(F.col("severity"))).drop("alert_id"), "measure_value")


def alert_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = F.create_map(F.lit("b"), F.col("k").cast("double"), F.lit("a"), F.col("device_id").cast("double"))
    body = alerts.message_body(numbers, F.create_map(F.lit("measure"), F.col("measure")))
    return _alerts(spark, sf_dir).select("sequence_number", body.alias("body"))


QUERIES = {
    f.__name__: f
    for f in (
        severity_levels, alert_text, alerts_from_messages, acknowledged_alerts, alerts_from_windows, alert_suppression, sink_cooldown, alert_batches, alert_routing, alert_metrics, alert_points_long, alert_body,
    )
}

_SEVERITY = "CASE WHEN ratio >= 3 THEN 'CRITICAL' WHEN ratio >= 2 THEN 'HIGH' WHEN ratio >= 1.5 THEN 'MEDIUM' ELSE 'LOW' END"
_LEVEL = "CASE severity WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'HIGH' THEN 3 ELSE 4 END::BIGINT"
_ALERTS = f"""{SQL}, x AS (SELECT *, score / {LOW}::DOUBLE AS ratio FROM e), a AS (
  SELECT *, {_SEVERITY} AS severity FROM x WHERE score > {LOW}::DOUBLE
)"""

ORACLES = {
    "severity_levels": f"""WITH {SQL}, x AS (SELECT sequence_number, score / {LOW}::DOUBLE AS ratio FROM e), s AS (SELECT sequence_number, {_SEVERITY} AS severity FROM x)
        SELECT sequence_number, severity, {_LEVEL} AS level FROM s""",
    "alert_text": f"""WITH {SQL}, x AS (SELECT *, floor(value) AS whole, floor(value) / 50.0::DOUBLE AS ratio FROM e WHERE floor(value) > 50)
        SELECT sequence_number, {_SEVERITY} || ' Anomaly Detected on ' || device_id || ' - ' || measure AS alert_title,
        printf('Anomaly score %.2f exceeds threshold %.2f (%.2fx). Group: %s, Device: %s', whole, 50.0::DOUBLE, ratio, measure, device_id::VARCHAR) AS alert_description FROM x""",
    "alerts_from_messages": f"""WITH {_ALERTS} SELECT sha256('SINGLE_POINT|' || device_id || '|' || measure || '|' || edge_ms) AS alert_id, device_id, sequence_number, 'SINGLE_POINT' AS alert_type, severity,
        edge_ms AS timestamp_ms, measure, round(score, 6) AS score, {LOW}::DOUBLE AS threshold, 'NEW' AS alert_status, false AS is_acknowledged, measure AS measures, round(value, 6) AS involved,
        sequence_number::VARCHAR AS related FROM a""",
    "acknowledged_alerts": f"""WITH {_ALERTS} SELECT sequence_number, k < 20 AS is_acknowledged, CASE WHEN k < 10 THEN 'second' WHEN k < 20 THEN 'first' ELSE '' END AS by,
        CASE WHEN k < 10 THEN edge_ms + 30000 WHEN k < 20 THEN edge_ms + 60000 ELSE 0 END AS at_ms, CASE WHEN k < 20 THEN 'ACKNOWLEDGED' ELSE 'NEW' END AS alert_status FROM a""",
    "alerts_from_windows": f"""WITH {_DAILY}, c AS (SELECT device_id, measure, window_start_ms, max(score) AS score, max(score) / {THRESHOLD}::DOUBLE AS ratio, first(edge_ms ORDER BY score DESC, edge_ms, sequence_number) AS top_ms
        FROM w GROUP BY ALL), ids AS (SELECT device_id, window_start_ms, string_agg(sequence_number::VARCHAR, ',' ORDER BY edge_ms, sequence_number) AS messages FROM w GROUP BY ALL)
        SELECT sha256('WINDOW_AGGREGATE|' || device_id || '|' || measure || '|' || top_ms) AS alert_id, device_id, measure, window_start_ms, {_SEVERITY} AS severity, top_ms AS timestamp_ms,
        round(score, 6) AS score, 'WINDOW_AGGREGATE' AS alert_type, messages, device_id || '_' || window_start_ms || '_' || (window_start_ms + {DAY_MS}) AS windows, 0::INT AS involved
        FROM c JOIN ids USING (device_id, window_start_ms) WHERE score > {THRESHOLD}::DOUBLE""",
    "alert_suppression": f"""WITH RECURSIVE {_ALERTS}, n AS (SELECT device_id, sequence_number, edge_ms, ratio, row_number() OVER (PARTITION BY device_id ORDER BY edge_ms, sequence_number) AS n FROM a),
        r AS (SELECT device_id, sequence_number, n, edge_ms AS last_ms, true AS emitted FROM n WHERE n = 1 UNION ALL
        SELECT n.device_id, n.sequence_number, n.n, CASE WHEN (n.edge_ms - r.last_ms < {DAY_MS} AND n.ratio < 3) OR (n.edge_ms - r.last_ms < {5 * DAY_MS} AND n.ratio < 1.5) THEN r.last_ms ELSE n.edge_ms END,
        NOT ((n.edge_ms - r.last_ms < {DAY_MS} AND n.ratio < 3) OR (n.edge_ms - r.last_ms < {5 * DAY_MS} AND n.ratio < 1.5))
        FROM r JOIN n ON n.device_id = r.device_id AND n.n = r.n + 1) SELECT device_id, sequence_number FROM r WHERE emitted""",
    "sink_cooldown": f"""WITH RECURSIVE {_ALERTS}, n AS (SELECT device_id, measure, severity, sequence_number, edge_ms, row_number() OVER (PARTITION BY device_id, measure, severity ORDER BY edge_ms, sequence_number) AS n FROM a),
        r AS (SELECT device_id, measure, severity, sequence_number, n, edge_ms AS last_ms, true AS notified FROM n WHERE n = 1 UNION ALL
        SELECT n.device_id, n.measure, n.severity, n.sequence_number, n.n, CASE WHEN n.edge_ms - r.last_ms < {3 * DAY_MS} AND n.severity <> 'CRITICAL' THEN r.last_ms ELSE n.edge_ms END,
        NOT (n.edge_ms - r.last_ms < {3 * DAY_MS} AND n.severity <> 'CRITICAL')
        FROM r JOIN n ON n.device_id = r.device_id AND n.measure = r.measure AND n.severity = r.severity AND n.n = r.n + 1) SELECT device_id, measure, severity, sequence_number, notified FROM r""",
    "alert_batches": f"""WITH {_ALERTS}, f AS (SELECT *, edge_ms // {12 * HOUR_MS} AS flush FROM a), b AS (SELECT *, (row_number() OVER (PARTITION BY flush ORDER BY edge_ms, sequence_number) - 1) // 10 AS batch FROM f)
        SELECT flush, batch, count(*) AS alerts, min(sequence_number) AS first FROM b GROUP BY ALL""",
    "alert_routing": f"""WITH {_ALERTS} SELECT sequence_number, severity, CASE WHEN severity = 'LOW' THEN 'Console,Log,CloudWatch' ELSE 'Console,Log,CloudWatch,SNS' END AS channels FROM a""",
    "alert_metrics": f"""WITH {_ALERTS} SELECT device_id, measure, severity, 'AnomalyScore' AS metric, round(score, 6) AS value FROM a UNION ALL SELECT device_id, measure, severity, 'AlertCount', 1.0 FROM a""",
    "alert_points_long": f"""WITH {_ALERTS}, p AS (SELECT *, 'anomaly_score' AS n, 'DOUBLE' AS t, score AS v FROM a UNION ALL SELECT *, 'anomaly_threshold', 'DOUBLE', {LOW} FROM a UNION ALL
        SELECT *, 'severity_level', 'BIGINT', ({_LEVEL})::DOUBLE FROM a UNION ALL SELECT *, 'measurement_' || measure, 'DOUBLE', value FROM a) SELECT device_id, 'SINGLE_POINT' AS alert_type, severity, measure, n AS measure_name, t AS measure_value_type, round(v, 6) AS measure_value, edge_ms AS time FROM p""",
    "alert_body": f"""WITH {_ALERTS} SELECT sequence_number, 'Measurements:' || chr(10) || printf('  a: %.4f', device_id::DOUBLE) || chr(10) || printf('  b: %.4f', k::DOUBLE) || chr(10) || 'Metadata:' || chr(10)
        || '  measure: ' || measure AS body FROM a""",
}
