"""Queries over messages: parsing, duplicates, sequences, order, clocks, window deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import anomaly, parsing
from ..functions.times import DAY_MS, HOUR_MS, MINUTE_MS, floor_ms
from ..operators import points, quality, stats, windows
from .tables import SQL, THRESHOLD, readings
from .window_queries import _DAILY, _SCORES, GRID, WINDOW, daily, gridded, rounded

ORDER = ["edge_ms", "sequence_number"]


def _json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON: typed messages at even numbers, flat objects at odd ones, with a field that is no number."""
    read = readings(spark, sf_dir)
    typed = F.to_json(F.struct(F.col("device_id").cast("string").alias("device_id"), F.create_map(F.col("measure"), F.col("value")).alias("measurements")))
    flat = F.to_json(F.struct(F.col("value").alias("xmeas_1"), F.col("k").alias("xmeas_2"), F.col("measure").alias("note")))
    return read.withColumn("json", F.when(F.col("sequence_number") % 2 == 0, typed).otherwise(flat))


def json_map_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = _json(spark, sf_dir).withColumn("message", parsing.parse_message(F.col("json")))
    total = F.aggregate(F.map_values("message.measurements"), F.lit(0.0), lambda a, x: a + x)
    return rounded(message.select("sequence_number", "message.device_id", F.size("message.measurements").alias("measures"), total.alias("total")), "total")


def device_key_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.element_at(F.array(F.lit('{"device_id":"d7"}'), F.lit('{"x":1}'), F.lit("bad")), (F.col("sequence_number") % 3 + 1).cast("int"))
    return readings(spark, sf_dir).select("sequence_number", parsing.device_key(kinds).alias("device"))


def json_to_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.to_json(F.struct("k", F.col("sequence_number").alias("sample"), F.col("measure").alias("other")))
    return readings(spark, sf_dir).select("sequence_number", parsing.csv_line(text, "sample bigint, k bigint").alias("line"))


def _three_scores() -> dict[str, Column]:
    """Scores by the names that points and enriched messages give them."""
    return {"anomaly_score_stream6": F.col("score"), "anomaly_score_stream9": F.col("k") / 40, "anomaly_score_stream_11": F.col("device_id") % 7 / 3}


def json_long_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point for each number of every flat message, and for its three scores."""
    flat = F.to_json(F.struct(F.col("value").alias("xmeas_1"), F.col("k").alias("xmeas_2"), F.col("measure").alias("note")))
    held = readings(spark, sf_dir).withColumn("numbers", parsing.numeric_map(flat))
    found = points.json_points(held, F.col("numbers"), _three_scores(), {"factory": F.lit("test-factory-1")}, "edge_ms", ["sequence_number"])
    return rounded(found, "measure_value")


def enriched_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as objects of strings, with the time of processing and three scores."""
    scores = {name: score.cast("decimal(12,4)").cast("string") for name, score in _three_scores().items()}
    added = {"proc_time_ms": F.col("edge_ms").cast("string"), **scores}
    texts = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(*[x for name, text in added.items() for x in (F.lit(name), text)]))
    return readings(spark, sf_dir).select("sequence_number", F.to_json(texts).alias("json"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a day as records."""
    held = daily(spark, sf_dir).withColumn("id", F.col("sequence_number").cast("string")).withColumn("key", F.col("k").cast("string"))
    found = stats.window_records(held, WINDOW, ORDER, "measure", "id", "key", THRESHOLD)
    return found.withColumns(
        {
            "window_id": parsing.window_id(F.col("device_id"), F.col("window_start_ms"), F.col("window_end_ms")),
            "device_id": F.col("device_id").cast("string"),
            "edge_processed_timestamp_ms": F.col("window_end_ms") + 5000,
            "is_suspect_window": F.size(F.array_distinct("idempotency_keys")) < F.size("idempotency_keys"),
            "metadata": F.create_map(F.lit("messages"), F.col("message_count").cast("string")),
        }
    )


def envelope_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is read back from every window's envelope: its keys, and each of its fields."""
    json = parsing.envelope(F.concat(F.lit("tx-"), F.col("window_id")), F.lit(-1))
    sent = _records(spark, sf_dir).select(json.alias("json")).withColumn("w", parsing.parse_window(F.col("json")))
    keys = F.array_join(F.array_sort(F.json_object_keys("json")), ",")
    total = F.aggregate(F.map_values("w.aggregated_measurements"), F.lit(0.0), lambda a, x: a + x["sum"] + x["first"] * 2 + x["max"] * 3)
    top = F.aggregate(F.map_values("w.aggregated_anomaly_scores"), F.lit(0.0), lambda a, x: F.greatest(a, x["max"]))
    found = sent.select(
        "w.window_id", "w.device_id", "w.window_start_ms", "w.window_end_ms", "w.message_count", "w.edge_processed_timestamp_ms", "w.is_suspect_window", keys.alias("keys"),
        F.get_json_object("json", "$.transaction_id").alias("transaction_id"), F.get_json_object("json", "$.checkpoint_id").cast("long").alias("checkpoint_id"),
        F.array_join("w.message_ids", ",").alias("message_ids"), F.array_join("w.idempotency_keys", ",").alias("idempotency_keys"),
        F.array_join(F.array_sort(F.map_keys("w.aggregated_measurements")), ",").alias("measures"), total.alias("total"), top.alias("top"),
        F.element_at("w.metadata", F.lit("messages")).alias("messages"),
    )
    return rounded(found, "total", "top")


def stamped_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cloud = F.col("edge_ms") + 5000 + F.col("k")
    offset = anomaly.offset_sample(cloud, F.col("edge_ms"), F.lit(10))
    read = readings(spark, sf_dir)
    return read.select(
        "sequence_number", F.lit("edge-1").alias("device"), cloud.alias("cloud_timestamp_ms"), offset.alias("clock_offset_ms"), anomaly.corrected_ms(F.col("edge_ms"), offset).alias("corrected_timestamp_ms")
    )


def idempotency_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth key is missing, and such a message is nobody's duplicate."""
    keyed = readings(spark, sf_dir).withColumn("key", F.when(F.col("k") % 10 > 0, F.col("k")))
    return quality.flag_duplicates(keyed, ["device_id", "key"], ["sequence_number"]).select("device_id", "sequence_number", "k", "is_duplicate")


def duplicate_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = quality.flag_duplicates(readings(spark, sf_dir), ["device_id", "k"], ["sequence_number"])
    scored = flagged.withColumn("scored", F.when(~F.col("is_duplicate"), F.col("score")))
    return rounded(scored.groupBy("device_id").agg(F.count("*").alias("passed"), F.count("scored").alias("scored"), F.count_if(~F.col("is_duplicate")).alias("kept"), F.max("scored").alias("top")), "top")


def sequence_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.sequence_gaps(readings(spark, sf_dir), ["device_id"], ["sequence_number"]).where("sequence_gap is not null").select("device_id", "sequence_number", "sequence_gap")


def drift_excess(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.col("edge_ms") + 5000 + (F.col("k") - 50) * 200
    return readings(spark, sf_dir).select("sequence_number", quality.excessive_drift(F.col("edge_ms"), F.lit(5000), now).alias("excessive"))


def group_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = daily(spark, sf_dir).groupBy(*WINDOW, "measure").agg(F.max("value").alias("value"))
    maps = means.groupBy(*WINDOW).agg(F.map_from_entries(F.collect_list(F.struct("measure", "value"))).alias("m"))
    maps = maps.withColumn("vector", parsing.group_vector(F.col("m"), ["click", "error", "view"]))
    others = F.size(F.map_filter("m", lambda k, _: ~k.isin("click", "error", "view")))
    return maps.select(*WINDOW, *[F.get("vector", F.lit(i)).alias(f"v{i}") for i in range(3)], others.alias("others"))


def _replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings, every seventh of which comes again later with a new id."""
    read = readings(spark, sf_dir).withColumn("arrival", F.col("sequence_number"))
    again = read.where("sequence_number % 7 = 0").withColumn("arrival", F.col("arrival") + 10_000_000)
    return read.unionByName(again)


def content_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _replayed(spark, sf_dir).withColumn("key", parsing.content_key(F.col("device_id"), F.col("edge_ms"), F.create_map(F.col("measure"), F.col("value"))))
    unique = quality.drop_duplicates(keyed, ["device_id", "key"], ["arrival"])
    return unique.groupBy("device_id").agg(F.count("*").alias("messages"), F.max("arrival").alias("last_arrival"))


def content_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.create_map(F.lit("z"), F.col("k").cast("string"), F.lit("a"), F.col("device_id").cast("string"))
    return readings(spark, sf_dir).select("sequence_number", parsing.content_key(F.col("device_id"), F.col("edge_ms"), held).alias("key"))


def time_content_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = readings(spark, sf_dir).select("device_id", "measure", "edge_ms", "sequence_number")
    return quality.within_horizon(keyed, ["device_id", "measure"], ORDER, 2 * DAY_MS).select("device_id", "measure", "sequence_number", "is_repeat")


def _disordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings in another order of arrival."""
    return readings(spark, sf_dir).withColumn("arrival", F.col("sequence_number") + F.col("k") % 5 * 400)


def sequence_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.validate_sequence(_disordered(spark, sf_dir), ["device_id"], ["arrival", "sequence_number"])
    return found.select("device_id", "sequence_number", "sequence_valid")


def tie_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    coarse = readings(spark, sf_dir).withColumn("edge_ms", floor_ms("edge_ms", 12 * HOUR_MS))
    return quality.flag_ties(coarse, ["device_id"], ORDER).groupBy("device_id").agg(F.count_if("out_of_order").alias("ties"))


def suspect_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = windows.event_windows(_disordered(spark, sf_dir), "1 day")
    flagged = quality.flag_duplicates(held, ["device_id", "k"], ORDER)
    flagged = quality.flag_ties(flagged, WINDOW, ORDER)
    flagged = quality.validate_sequence(flagged, ["device_id"], ["arrival", "sequence_number"])
    return quality.suspect_windows(flagged, WINDOW)


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.collected_ids(daily(spark, sf_dir), WINDOW, ORDER, message_ids="sequence_number", keys="k")


def window_dedup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = parsing.window_key(F.col("device_id"), F.col("window_start_ms"), F.col("window_end_ms"), F.col("message_count"), F.transform("message_ids", lambda i: F.lpad(i.cast("string"), 12, "0")))
    return _windows(spark, sf_dir).select(*WINDOW, key.alias("key"))


def cloud_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = _windows(spark, sf_dir).withColumn("window_key", parsing.window_id(F.col("device_id"), F.col("window_start_ms"), F.col("window_end_ms")))
    held = held.withColumn("idempotency_keys", F.transform(F.array_distinct("keys"), lambda k: k.cast("string")))
    return quality.accept_windows(held.select(*WINDOW, "window_key", "idempotency_keys"), ttl_ms=None).select(*WINDOW, "accepted")


def cloud_window_dedup_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As cloud_window_dedup(), with transactions of four days, and keys that are forgotten after a week."""
    held = _windows(spark, sf_dir).withColumn("window_key", parsing.window_id(F.col("device_id"), F.col("window_start_ms"), F.col("window_end_ms")))
    held = held.withColumn("idempotency_keys", F.transform(F.array_distinct("keys"), lambda k: k.cast("string")))
    held = held.withColumn("transaction_id", F.when(F.col("message_count") % 3 > 0, F.floor(F.col("window_start_ms") / (4 * DAY_MS))))
    return quality.accept_windows(held.select(*WINDOW, "window_key", "idempotency_keys", "transaction_id"), 7 * DAY_MS, transaction="transaction_id").select(*WINDOW, "accepted")


def out_of_order_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = _windows(spark, sf_dir).withColumn("arrival", F.col("window_start_ms") + F.col("message_count") % 3 * 2 * DAY_MS + F.col("message_count"))
    held = held.withColumn("arrival", F.col("arrival") * 100 + F.pmod(F.floor(F.col("window_start_ms") / DAY_MS), F.lit(100)))
    return quality.out_of_order_windows(held).select(*WINDOW, "is_out_of_order")


def receipt_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    noted = F.map_entries(quality.receipt(F.create_map(F.lit("messages"), F.col("message_count").cast("string")), F.col("window_end_ms") + 1000))
    text = F.array_join(F.transform(F.array_sort(noted), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return _windows(spark, sf_dir).select(*WINDOW, text.alias("metadata"))


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = readings(spark, sf_dir)
    cloud = F.col("edge_ms") + 5000 + (F.col("k") - 50) * 10 + F.when(F.col("k") == 99, 20_000).otherwise(0)
    return read.withColumn("offset_ms", anomaly.offset_sample(cloud, F.col("edge_ms"), 50 + F.col("k") % 50))


def clock_offset_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.rolling_offsets(_samples(spark, sf_dir), ["device_id"], "sequence_number")
    return gridded(found.select("device_id", "sequence_number", "offset_ms", "median_ms", "std_ms", "estimate_ms", "initialised"), "std_ms")


def clock_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets where a device's clock is set anew, which forgets its samples."""
    anew = stats.with_resets(_samples(spark, sf_dir), ["device_id"], "sequence_number", F.col("k") >= 97)
    found = stats.rolling_offsets(anew, ["device_id", "epoch"], "sequence_number")
    return found.select("device_id", "epoch", "sequence_number", "samples", "median_ms", "estimate_ms", "initialised", "exceed_count")


def drift_exceeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.rolling_offsets(_samples(spark, sf_dir), ["device_id"], "sequence_number").select("device_id", "sequence_number", "exceeded", "exceed_count")


def timestamp_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.rolling_offsets(_samples(spark, sf_dir), ["device_id"], "sequence_number")
    return found.select("sequence_number", anomaly.corrected_ms(F.col("edge_ms"), F.col("estimate_ms")).alias("corrected_timestamp_ms"))


def clock_sampling_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = readings(spark, sf_dir).select("device_id", "edge_ms", "sequence_number")
    return quality.sample_clock(read, ["device_id"], ORDER, interval_ms=DAY_MS).select("device_id", "sequence_number", "sampled")


def legacy_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = floor_ms("edge_ms", MINUTE_MS)
    read = readings(spark, sf_dir).select("device_id", "sequence_number", start.alias("window_start_ms"), (start + MINUTE_MS).alias("window_end_ms"), F.lit(1).cast("long").alias("message_count"))
    return read.withColumn("window_id", parsing.window_id(F.col("device_id"), F.col("window_start_ms"), F.col("window_end_ms")))


def bloom_sizing(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, p = (F.col("n_nationkey") + 1) * 10_000, F.lit(0.01) / (F.col("n_regionkey") + 1)
    sized = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", n.alias("n"), anomaly.bloom_bits(n, p).cast("long").alias("bits"))
    sized = sized.withColumn("hashes", anomaly.bloom_hashes(F.col("n"), F.col("bits")).cast("long"))
    return rounded(sized.withColumn("half_full_fpp", anomaly.bloom_fpp(F.col("n") / 2, F.col("bits"), F.col("hashes"))), "half_full_fpp")


QUERIES = {
    f.__name__: f
    for f in (
        json_map_parse, clock_reset, cloud_window_dedup_ttl, device_key_extract, json_to_csv, json_long_points, enriched_json, envelope_json, stamped_messages, idempotency_flag, duplicate_passthrough, sequence_gap,
        drift_excess, group_vectors, content_dedup, content_keys, time_content_dedup, sequence_validate, tie_count, suspect_windows, window_dedup_key, cloud_window_dedup,
        out_of_order_windows, receipt_metadata, clock_offset_rolling, drift_exceeded, timestamp_correction, clock_sampling_policy, legacy_window, bloom_sizing,
    )
}

_WINDOWS = f"""{_DAILY}, v AS (
  SELECT device_id, window_start_ms, window_end_ms, count(*) AS message_count, list(k ORDER BY edge_ms, sequence_number) AS keys,
         string_agg(lpad(sequence_number::VARCHAR, 12, '0'), ',' ORDER BY sequence_number) AS ids FROM w GROUP BY ALL
)"""
def _clock(key: str, source: str) -> str:
    """Offset estimates over the samples of a key (columns of source)."""
    on = " AND ".join(f"a.{c} = b.{c}" for c in key.split(", "))
    mine, joined = ", ".join(f"a.{c}" for c in key.split(", ")), ", ".join(f"m.{c}" for c in key.split(", "))
    return f"""{SQL}, i AS (
  SELECT *, (5000 + (k - 50) * 10 + CASE WHEN k = 99 THEN 20000 ELSE 0 END) - (50 + k % 50) // 2 AS offset_ms,
         count(*) FILTER (WHERE k >= 97) OVER (PARTITION BY device_id ORDER BY sequence_number ROWS UNBOUNDED PRECEDING) AS epoch FROM e
), o AS (
  SELECT {key}, sequence_number, edge_ms, offset_ms FROM {source}
), n AS (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY sequence_number) AS n FROM o
), j AS (
  SELECT {mine}, a.sequence_number, a.edge_ms, a.offset_ms, a.n, list_sort(list(b.offset_ms)) AS recent, stddev_pop(b.offset_ms) AS std_ms
  FROM n a JOIN n b ON {on} AND b.n BETWEEN a.n - 99 AND a.n GROUP BY {mine}, a.sequence_number, a.edge_ms, a.offset_ms, a.n
), m AS (
  SELECT *, CASE WHEN len(recent) % 2 = 1 THEN recent[len(recent) // 2 + 1] ELSE trunc((recent[len(recent) // 2] + recent[len(recent) // 2 + 1]) / 2.0::DOUBLE)::BIGINT END AS median_ms FROM j
), kept AS (
  SELECT {joined}, m.sequence_number, avg(b.offset_ms) AS mean FROM m JOIN n b ON {on.replace("a.", "m.")} AND b.n BETWEEN m.n - 99 AND m.n
  WHERE abs(b.offset_ms - m.median_ms) <= 2 * m.std_ms GROUP BY {joined}, m.sequence_number
), z AS (
  SELECT m.*, len(recent) >= 10 AS initialised, CASE WHEN len(recent) >= 10 THEN trunc(mean)::BIGINT END AS estimate_ms
  FROM m LEFT JOIN kept USING ({key}, sequence_number)
)"""


_CLOCK = _clock("device_id", "i")

ORACLES = {
    "json_map_parse": f"""WITH {SQL} SELECT sequence_number, CASE WHEN sequence_number % 2 = 0 THEN device_id::VARCHAR END AS device_id, CASE WHEN sequence_number % 2 = 0 THEN 1 ELSE 2 END AS measures,
        round(CASE WHEN sequence_number % 2 = 0 THEN value ELSE value + k END, 6) AS total FROM e""",
    "device_key_extract": f"""WITH {SQL} SELECT sequence_number, CASE WHEN sequence_number % 3 = 0 THEN 'd7' ELSE 'unknown' END AS device FROM e""",
    "json_to_csv": f"""WITH {SQL} SELECT sequence_number, sequence_number || ',' || k AS line FROM e""",
    "json_long_points": f"""WITH {SQL}, p AS (SELECT sequence_number, edge_ms AS time, 'xmeas_1' AS measure_name, value AS v FROM e UNION ALL SELECT sequence_number, edge_ms, 'xmeas_2', k::DOUBLE FROM e UNION ALL
        SELECT sequence_number, edge_ms, 'anomaly_score_stream6', score FROM e UNION ALL SELECT sequence_number, edge_ms, 'anomaly_score_stream9', k / 40.0::DOUBLE FROM e UNION ALL
        SELECT sequence_number, edge_ms, 'anomaly_score_stream_11', device_id % 7 / 3.0::DOUBLE FROM e)
        SELECT sequence_number, measure_name, 'DOUBLE' AS measure_value_type, round(v, 6) AS measure_value, time, 'test-factory-1' AS factory FROM p""",
    "enriched_json": f"""WITH {SQL} SELECT sequence_number, '{{"k":"' || k || '","proc_time_ms":"' || edge_ms || '","anomaly_score_stream6":"' || score::DECIMAL(12,4) || '","anomaly_score_stream9":"' ||
        (k / 40.0::DOUBLE)::DECIMAL(12,4) || '","anomaly_score_stream_11":"' || (device_id % 7 / 3.0::DOUBLE)::DECIMAL(12,4) || '"}}' AS json FROM e""",
    "envelope_json": f"""WITH {_SCORES}, h AS (SELECT device_id, window_start_ms, window_end_ms, count(*) AS n, string_agg(sequence_number::VARCHAR, ',' ORDER BY edge_ms, sequence_number) AS message_ids,
        string_agg(k::VARCHAR, ',' ORDER BY edge_ms, sequence_number) AS idempotency_keys, count(DISTINCT k) < count(*) AS twice FROM w GROUP BY ALL),
        q AS (SELECT device_id, window_start_ms, string_agg(measure, ',' ORDER BY measure) AS measures, sum(sum + first * 2 + max * 3) AS total FROM s GROUP BY ALL),
        t AS (SELECT device_id, window_start_ms, max(max) AS top FROM c GROUP BY ALL)
        SELECT h.device_id || '_' || h.window_start_ms || '_' || h.window_end_ms AS window_id, h.device_id::VARCHAR AS device_id, h.window_start_ms, h.window_end_ms, n AS message_count,
        h.window_end_ms + 5000 AS edge_processed_timestamp_ms, twice AS is_suspect_window, 'aggregated_anomaly_scores,aggregated_measurements,checkpoint_id,device_id,edge_processed_timestamp_ms,idempotency_keys,'
        || 'is_suspect_window,message_count,message_ids,metadata,transaction_id,window_end_ms,window_id,window_start_ms' AS keys,
        'tx-' || h.device_id || '_' || h.window_start_ms || '_' || h.window_end_ms AS transaction_id, -1::BIGINT AS checkpoint_id, message_ids, idempotency_keys, measures, round(total, 6) AS total,
        round(top, 6) AS top, n::VARCHAR AS messages FROM h JOIN q USING (device_id, window_start_ms) JOIN t USING (device_id, window_start_ms)""",
    "stamped_messages": f"""WITH {SQL} SELECT sequence_number, 'edge-1' AS device, edge_ms + 5000 + k AS cloud_timestamp_ms, 5000 + k - 5 AS clock_offset_ms, edge_ms + 5000 + k - 5 AS corrected_timestamp_ms FROM e""",
    "idempotency_flag": f"""WITH {SQL} SELECT device_id, sequence_number, k, k % 10 > 0 AND row_number() OVER (PARTITION BY device_id, k ORDER BY sequence_number) > 1 AS is_duplicate FROM e""",
    "duplicate_passthrough": f"""WITH {SQL}, d AS (SELECT *, row_number() OVER (PARTITION BY device_id, k ORDER BY sequence_number) AS n FROM e)
        SELECT device_id, count(*) AS passed, count(*) FILTER (WHERE n = 1) AS scored, count(*) FILTER (WHERE n = 1) AS kept, round(max(score) FILTER (WHERE n = 1), 6) AS top FROM d GROUP BY device_id""",
    "sequence_gap": f"""WITH {SQL}, g AS (SELECT device_id, sequence_number, sequence_number - (lag(sequence_number) OVER (PARTITION BY device_id ORDER BY sequence_number) + 1) AS sequence_gap FROM e)
        SELECT * FROM g WHERE sequence_gap <> 0""",
    "drift_excess": f"""WITH {SQL} SELECT sequence_number, abs((k - 50) * 200) > 5000 AS excessive FROM e""",
    "group_vectors": f"""WITH {_DAILY}, m AS (SELECT device_id, window_start_ms, window_end_ms, measure, max(value) AS value FROM w GROUP BY ALL), p AS (
        SELECT device_id, window_start_ms, window_end_ms, max(CASE WHEN measure = 'click' THEN value END) AS a, max(CASE WHEN measure = 'error' THEN value END) AS b,
        max(CASE WHEN measure = 'view' THEN value END) AS c, count(*) FILTER (WHERE measure NOT IN ('click', 'error', 'view'))::INT AS others FROM m GROUP BY ALL)
        SELECT device_id, window_start_ms, window_end_ms, CASE WHEN coalesce(a, b, c) IS NOT NULL THEN coalesce(a, 0.0) END AS v0, CASE WHEN coalesce(a, b, c) IS NOT NULL THEN coalesce(b, 0.0) END AS v1,
        CASE WHEN coalesce(a, b, c) IS NOT NULL THEN coalesce(c, 0.0) END AS v2, others FROM p""",
    "content_dedup": f"""WITH {SQL} SELECT device_id, count(*) AS messages, max(sequence_number) AS last_arrival FROM e GROUP BY device_id""",
    "content_keys": f"""WITH {SQL} SELECT sequence_number, device_id || '|' || edge_ms || '|a:' || device_id || '|z:' || k AS key FROM e""",
    "time_content_dedup": f"""WITH RECURSIVE {SQL}, n AS (SELECT device_id, measure, edge_ms, sequence_number, row_number() OVER (PARTITION BY device_id, measure ORDER BY edge_ms, sequence_number) AS n FROM e),
        r AS (SELECT device_id, measure, sequence_number, n, edge_ms AS last_ms, false AS is_repeat FROM n WHERE n = 1 UNION ALL
        SELECT n.device_id, n.measure, n.sequence_number, n.n, CASE WHEN n.edge_ms - r.last_ms <= {2 * DAY_MS} THEN r.last_ms ELSE n.edge_ms END, n.edge_ms - r.last_ms <= {2 * DAY_MS}
        FROM r JOIN n ON n.device_id = r.device_id AND n.measure = r.measure AND n.n = r.n + 1) SELECT device_id, measure, sequence_number, is_repeat FROM r""",
    "sequence_validate": f"""WITH {SQL} SELECT device_id, sequence_number, coalesce(sequence_number > max(sequence_number) OVER (PARTITION BY device_id ORDER BY sequence_number + k % 5 * 400, sequence_number
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS sequence_valid FROM e""",
    "tie_count": f"""WITH {SQL}, t AS (SELECT device_id, edge_ms // {12 * HOUR_MS} AS slot, count(*) AS n FROM e GROUP BY ALL) SELECT device_id, sum(n - 1)::BIGINT AS ties FROM t GROUP BY device_id""",
    "suspect_windows": f"""WITH {_DAILY}, f AS (SELECT *, row_number() OVER (PARTITION BY device_id, k ORDER BY edge_ms, sequence_number) > 1 AS dup,
        coalesce(edge_ms <= lag(edge_ms) OVER (PARTITION BY device_id, window_start_ms ORDER BY edge_ms, sequence_number), false) AS tie,
        coalesce(sequence_number > max(sequence_number) OVER (PARTITION BY device_id ORDER BY sequence_number + k % 5 * 400, sequence_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS valid FROM w)
        SELECT device_id, window_start_ms, window_end_ms, count(*) AS rows, count(*) FILTER (WHERE dup) AS duplicate_count, count(*) FILTER (WHERE tie OR NOT valid) AS out_of_order_count,
        count(*) FILTER (WHERE dup) > 0 OR count(*) FILTER (WHERE tie OR NOT valid) > 0 AS is_suspect_window FROM f GROUP BY ALL""",
    "window_dedup_key": f"""WITH {_WINDOWS} SELECT device_id, window_start_ms, window_end_ms, device_id || '|' || window_start_ms || '|' || window_end_ms || '|' || message_count || '|' || ids AS key FROM v""",
    "cloud_window_dedup": f"""WITH RECURSIVE {_WINDOWS}, n AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY window_start_ms) AS n FROM v),
        r AS (SELECT device_id, window_start_ms, window_end_ms, n, keys AS known, true AS accepted FROM n WHERE n = 1 UNION ALL
        SELECT n.device_id, n.window_start_ms, n.window_end_ms, n.n, CASE WHEN list_has_any(r.known, n.keys) THEN r.known ELSE list_concat(r.known, n.keys) END, NOT list_has_any(r.known, n.keys)
        FROM r JOIN n ON n.device_id = r.device_id AND n.n = r.n + 1) SELECT device_id, window_start_ms, window_end_ms, accepted FROM r""",
    "cloud_window_dedup_ttl": f"""WITH RECURSIVE {_WINDOWS}, y AS (SELECT device_id, window_start_ms, window_end_ms, CASE WHEN message_count % 3 > 0 THEN list_append(list_transform(keys, lambda x: 'k' || x),
        't' || window_start_ms // {4 * DAY_MS}) ELSE list_transform(keys, lambda x: 'k' || x) END AS own FROM v), n AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY window_start_ms) AS n FROM y),
        r AS (SELECT device_id, window_start_ms, window_end_ms, n, list_transform(own, lambda x: {{'m': x, 'at': window_end_ms}}) AS known, true AS accepted FROM n WHERE n = 1 UNION ALL
        SELECT n.device_id, n.window_start_ms, n.window_end_ms, n.n, CASE WHEN list_has_any(list_transform(list_filter(r.known, lambda x: n.window_end_ms - x.at <= {7 * DAY_MS}), lambda x: x.m), n.own) THEN r.known
        ELSE list_concat(r.known, list_transform(n.own, lambda x: {{'m': x, 'at': n.window_end_ms}})) END,
        NOT list_has_any(list_transform(list_filter(r.known, lambda x: n.window_end_ms - x.at <= {7 * DAY_MS}), lambda x: x.m), n.own)
        FROM r JOIN n ON n.device_id = r.device_id AND n.n = r.n + 1) SELECT device_id, window_start_ms, window_end_ms, accepted FROM r""",
    "out_of_order_windows": f"""WITH {_WINDOWS}, a AS (SELECT *, (window_start_ms + message_count % 3 * {2 * DAY_MS} + message_count) * 100 + window_start_ms // {DAY_MS} % 100 AS arrival FROM v)
        SELECT device_id, window_start_ms, window_end_ms, coalesce(window_start_ms < max(window_end_ms) OVER (PARTITION BY device_id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS is_out_of_order FROM a""",
    "receipt_metadata": f"""WITH {_WINDOWS} SELECT device_id, window_start_ms, window_end_ms, 'cloud_dedup_passed=true;cloud_received_timestamp_ms=' || (window_end_ms + 1000) || ';messages=' || message_count AS metadata FROM v""",
    "clock_offset_rolling": f"""WITH {_CLOCK} SELECT device_id, sequence_number, offset_ms, median_ms, round(std_ms * {GRID}) / {GRID} AS std_ms, estimate_ms, initialised FROM z""",
    "clock_reset": f"""WITH {_clock("device_id, epoch", "i")}, x AS (SELECT *, coalesce(abs(offset_ms - estimate_ms) > 5000, false) AS exceeded FROM z) SELECT device_id, epoch, sequence_number,
        len(recent)::INT AS samples, median_ms, estimate_ms, initialised, (sum(exceeded::INT) OVER (PARTITION BY device_id, epoch ORDER BY sequence_number ROWS UNBOUNDED PRECEDING))::BIGINT AS exceed_count FROM x""",
    "drift_exceeded": f"""WITH {_CLOCK}, x AS (SELECT *, coalesce(abs(offset_ms - estimate_ms) > 5000, false) AS exceeded FROM z) SELECT device_id, sequence_number, exceeded,
        (sum(exceeded::INT) OVER (PARTITION BY device_id ORDER BY sequence_number ROWS UNBOUNDED PRECEDING))::BIGINT AS exceed_count FROM x""",
    "timestamp_correction": f"""WITH {_CLOCK} SELECT sequence_number, edge_ms + coalesce(estimate_ms, 0) AS corrected_timestamp_ms FROM z""",
    "clock_sampling_policy": f"""WITH RECURSIVE {SQL}, n AS (SELECT device_id, edge_ms, sequence_number, row_number() OVER (PARTITION BY device_id ORDER BY edge_ms, sequence_number) AS n FROM e),
        r AS (SELECT device_id, sequence_number, n, 1 AS samples, edge_ms AS last_ms, true AS sampled FROM n WHERE n = 1 UNION ALL
        SELECT n.device_id, n.sequence_number, n.n, CASE WHEN r.samples < 10 OR n.edge_ms - r.last_ms > {DAY_MS} THEN r.samples + 1 ELSE r.samples END,
        CASE WHEN r.samples < 10 OR n.edge_ms - r.last_ms > {DAY_MS} THEN n.edge_ms ELSE r.last_ms END, r.samples < 10 OR n.edge_ms - r.last_ms > {DAY_MS}
        FROM r JOIN n ON n.device_id = r.device_id AND n.n = r.n + 1) SELECT device_id, sequence_number, sampled FROM r""",
    "legacy_window": f"""WITH {SQL}, m AS (SELECT device_id, sequence_number, edge_ms - edge_ms % {MINUTE_MS} AS s FROM e)
        SELECT device_id, sequence_number, s AS window_start_ms, s + {MINUTE_MS} AS window_end_ms, 1::BIGINT AS message_count, device_id || '_' || s || '_' || (s + {MINUTE_MS}) AS window_id FROM m""",
    "bloom_sizing": """WITH s AS (SELECT n_nationkey, ((n_nationkey + 1) * 10000)::BIGINT AS n, 0.01::DOUBLE / (n_regionkey + 1) AS p FROM nation),
        b AS (SELECT *, ceil(-n * ln(p) / 0.4804530139182014::DOUBLE)::BIGINT AS bits FROM s), h AS (SELECT *, ceil(bits::DOUBLE / n * 0.6931471805599453::DOUBLE)::BIGINT AS hashes FROM b)
        SELECT n_nationkey, n, bits, hashes, round(power(1 - exp(-hashes * (n / 2.0::DOUBLE) / bits), hashes), 6) AS half_full_fpp FROM h""",
}
