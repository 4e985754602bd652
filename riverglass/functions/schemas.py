"""Record types as DDL strings, which Spark takes wherever it takes a schema. Times are epoch milliseconds; enumerations are plain strings."""

from __future__ import annotations

STAGES = ("RAW", "EDGE_PREPROCESSED", "EDGE_AGGREGATED", "EDGE_DEDUPED", "CLOUD_RECEIVED", "CLOUD_SCORED", "CLOUD_ALERTED")
ALERT_TYPES = ("SINGLE_POINT", "WINDOW_AGGREGATE", "TREND_DETECTION", "PATTERN_MATCH", "SYSTEM_ERROR", "NETWORK_DISCONNECT", "CLOCK_DRIFT")
SEVERITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
ALERT_STATES = ("NEW", "ESCALATED", "ACKNOWLEDGED", "RESOLVED", "DISMISSED")


MESSAGE_DDL = (
    "message_id string, idempotency_key string, sequence_number bigint, device_id string, edge_timestamp_ms bigint, "
    "cloud_timestamp_ms bigint, corrected_timestamp_ms bigint, clock_offset_ms bigint, measurements map<string,double>, "
    "anomaly_scores map<string,double>, is_duplicate boolean, retry_count int, processing_stage string, checkpoint_id string, metadata map<string,string>"
)

MEASUREMENT_STATS_DDL = "count bigint, sum double, min double, max double, avg double, variance double, std_dev double, first double, last double"

SCORE_STATS_DDL = "count bigint, sum double, min double, max double, avg double, max_timestamp_ms bigint, anomaly_count bigint, threshold double"

WINDOW_DDL = (
    "window_id string, device_id string, window_start_ms bigint, window_end_ms bigint, message_count bigint, "
    f"aggregated_measurements map<string,struct<{MEASUREMENT_STATS_DDL.replace(' ', ':').replace(',:', ',')}>>, "
    f"aggregated_anomaly_scores map<string,struct<{SCORE_STATS_DDL.replace(' ', ':').replace(',:', ',')}>>, "
    "message_ids array<string>, idempotency_keys array<string>, edge_processed_timestamp_ms bigint, is_suspect_window boolean, metadata map<string,string>"
)

WINDOW_FIELDS = (
    "window_id", "device_id", "window_start_ms", "window_end_ms", "message_count", "aggregated_measurements", "aggregated_anomaly_scores",
    "message_ids", "idempotency_keys", "edge_processed_timestamp_ms", "is_suspect_window", "metadata",
)

ALERT_DDL = (
    "alert_id string, device_id string, alert_type string, severity string, timestamp_ms bigint, alert_title string, alert_description string, "
    "anomaly_group string, anomaly_score double, anomaly_threshold double, related_message_ids array<string>, related_window_ids array<string>, "
    "measurements_involved map<string,double>, is_acknowledged boolean, acknowledged_by string, acknowledged_timestamp_ms bigint, alert_status string, "
    "notification_channels array<string>, metadata map<string,string>"
)

POINT_DDL = "measure_name string, measure_value_type string, measure_value string, time bigint, time_unit string, dimensions map<string,string>"

OUTBOX_DDL = "message_id string, payload string, original_timestamp_ms bigint, stored_timestamp_ms bigint, last_retry_timestamp_ms bigint, retry_count int, priority int, is_persisted boolean"

#: A simulation run's CSV row: 41 measured and 11 manipulated variables.
CSV_COLUMNS = ("faultNumber", "simulationRun", "sample", *(f"xmeas_{i}" for i in range(1, 42)), *(f"xmv_{i}" for i in range(1, 12)))
CSV_DDL = ", ".join(f"{c} {'int' if i < 3 else 'double'}" for i, c in enumerate(CSV_COLUMNS))

#: Groups of measures that are scored together; a vector has them in this order.
SAMPLED_GROUPS = {"reactor_feed": range(23, 29), "purge_gas": range(29, 37), "product": range(37, 42)}
CONTINUOUS_GROUPS = {"stream6": range(6, 10), "stream9": range(10, 14), "stream11": range(15, 20)}


def group_measures(groups: dict[str, range]) -> dict[str, list[str]]:
    """The names of each group's measures."""
    return {name: [f"xmeas_{i}" for i in numbers] for name, numbers in groups.items()}

