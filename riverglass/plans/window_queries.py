"""Queries over windows: statistics, points, counts, shingles, thresholds, forests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.parsing import window_id
from ..functions.times import DAY_MS, HOUR_MS
from ..operators import points, scoring, stats, windows
from .tables import MEASURES, SQL, THRESHOLD, readings

KEYS = ["device_id", "measure", "window_start_ms", "window_end_ms"]
#: Variances are shown in steps of 1 / GRID. A value in cents has a variance that may lie halfway between two decimals,
#: and two ways to add would then round it apart; halfway between two such binary steps it can't lie.
GRID = 1 << 20
WINDOW = ["device_id", "window_start_ms", "window_end_ms"]


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles to six places, so that the order of a sum doesn't show."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def gridded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles to the nearest step of GRID."""
    return df.withColumns({c: F.round(F.col(c) * GRID) / GRID for c in columns})


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings in windows of a day."""
    return windows.event_windows(readings(spark, sf_dir), "1 day")


def tumbling_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.measurement_stats(daily(spark, sf_dir), KEYS)
    return gridded(rounded(found, "sum", "avg"), "variance", "std_dev")


def tumbling_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = windows.event_windows(readings(spark, sf_dir), "1 day", offset="6 hours")
    return held.groupBy("device_id", "window_start_ms").agg(F.count("*").alias("messages"), F.max("value").alias("max_value"))


def sliding_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = windows.event_windows(readings(spark, sf_dir), "2 days", "1 day")
    return rounded(held.groupBy("measure", "window_start_ms").agg(F.count("*").alias("messages"), F.avg("value").alias("mean")), "mean")


def score_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.score_stats(daily(spark, sf_dir), KEYS, THRESHOLD), "sum", "avg", "anomaly_ratio", "min", "max")


def high_score_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.score_stats(daily(spark, sf_dir), KEYS, THRESHOLD)
    folded = found.groupBy(*WINDOW).agg(F.map_from_entries(F.collect_list(F.struct("measure", F.struct("max", "count")))).alias("scores"))
    high = folded.where(F.exists(F.map_values("scores"), lambda s: s["max"] > 2.0))
    return high.select(*WINDOW, F.size("scores").alias("groups"))


def window_points_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = daily(spark, sf_dir)
    measured = points.stat_points(stats.measurement_stats(held, KEYS), ["device_id"], "window_end_ms")
    scored = points.score_points(stats.score_stats(held, KEYS, THRESHOLD), ["device_id"], "window_end_ms")
    counted = points.window_points(held.groupBy(*WINDOW).agg(F.count("*").alias("message_count")), ["device_id"])
    return rounded(measured.unionByName(scored).unionByName(counted), "measure_value")


def window_points_cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = daily(spark, sf_dir).withColumn("window_id", window_id(F.col("device_id"), F.col("window_start_ms"), F.col("window_end_ms")))
    by = ["device_id", "window_id"]
    measured = points.stat_points(stats.measurement_stats(named, [*KEYS, "window_id"]), by, "window_end_ms", with_count=True)
    scored = points.score_points(stats.score_stats(named, [*KEYS, "window_id"], THRESHOLD), by, "window_end_ms", with_ratio=True)
    counted = points.window_points(named.groupBy(*WINDOW, "window_id").agg(F.count("*").alias("message_count")), by, with_duration=False)
    return rounded(measured.unionByName(scored).unionByName(counted), "measure_value")


def metadata_numeric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("kind"), F.col("measure")))
    return points.map_points(readings(spark, sf_dir).withColumn("texts", texts), ["device_id", "sequence_number"], "edge_ms", "texts")


def id_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.collected_ids(daily(spark, sf_dir), WINDOW, ["edge_ms", "sequence_number"], message_ids="sequence_number", keys="k")
    return found.select(*WINDOW, "message_count", F.array_join("message_ids", ",").alias("message_ids"), F.array_join("keys", ",").alias("keys"))


def count_window_50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.count_windows(readings(spark, sf_dir), 50, "sequence_number").select("window", "first", "last", "messages")


def count_sliding_166_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = windows.count_slides(readings(spark, sf_dir), 166, 20, ["device_id"], "sequence_number", "value")
    return rounded(found.select("device_id", "sequence_number", "n", "in_window", "mean"), "mean")


def _elements(df: DataFrame, array: str, size: int, *keep: str) -> DataFrame:
    return df.select(*keep, *[F.get(array, F.lit(i)).alias(f"s{i}") for i in range(size)])


def shingle_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = windows.shingles(readings(spark, sf_dir), 4, ["device_id"], "sequence_number", F.array("value"))
    return _elements(plain.where("shingle is not null"), "shingle", 4, "device_id", "sequence_number")


def shingle_cyclic(spark: SparkSession, sf_dir: str) -> DataFrame:
    ring = windows.shingles(readings(spark, sf_dir), 4, ["device_id"], "sequence_number", F.array("value"), cyclic=True)
    return _elements(ring.where("shingle is not null"), "shingle", 4, "device_id", "sequence_number")


def _window_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = daily(spark, sf_dir)
    return held.groupBy(*WINDOW).agg(F.count("*").alias("message_count"), F.max("score").alias("score"), F.count_if(F.col("score") > THRESHOLD).alias("anomaly_count"), F.countDistinct("measure").alias("groups"))


def global_anomaly_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = _window_scores(spark, sf_dir)
    return rounded(stats.running_rate(held, ["device_id"], "window_start_ms", "anomaly_count", "groups").drop("score"), "global_anomaly_rate")


def time_since_last_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.time_since_anomaly(_window_scores(spark, sf_dir), ["device_id"]).select(*WINDOW, "time_since_last_anomaly_ms")


def p99_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.index_quantile(readings(spark, sf_dir), ["measure"], "value")


def adaptive_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A device's thresholds; histories are short here, as the tables have few readings of a device."""
    found = scoring.adaptive_threshold(readings(spark, sf_dir), ["device_id"], ["edge_ms", "sequence_number"], base=0.7, size=50, warm_up=20)
    found = found.withColumn("triggered", F.col("score") > F.col("adaptive_threshold"))
    return rounded(found.select("device_id", "sequence_number", "adaptive_threshold", "triggered"), "adaptive_threshold")


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per window the mean of each measure, 0 where missing."""
    means = daily(spark, sf_dir).groupBy(*WINDOW).pivot("measure", list(MEASURES)).agg(F.avg("value"))
    return means.select(*WINDOW, F.array(*[F.coalesce(m, F.lit(0.0)) for m in MEASURES]).alias("vector"))


def rcf_edge_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.forest_scores(_vectors(spark, sf_dir), ["device_id"], ["window_start_ms"], **scoring.EDGE).drop("vector")


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = daily(spark, sf_dir)
    since = scoring.time_since_anomaly(_window_scores(spark, sf_dir), ["device_id"])
    whole = since.select(*WINDOW, F.col("score").alias("edge_score"), "message_count", F.least("time_since_last_anomaly_ms", F.lit(100 * DAY_MS)).alias("since"))
    return scoring.features(stats.measurement_stats(held, KEYS).join(whole, WINDOW), WINDOW, list(MEASURES), "edge_score", "message_count", "since")


def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _elements(_features(spark, sf_dir), "vector", 3 * len(MEASURES) + 3, *WINDOW)
    return rounded(found, *[f"s{i}" for i in range(3 * len(MEASURES) + 3)])


def _secondary(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = windows.shingles(_features(spark, sf_dir), 4, ["device_id"], "window_start_ms", F.col("vector"), cyclic=True)
    scored = scoring.forest_scores(held.select(*WINDOW, "shingle"), ["device_id"], ["window_start_ms"], vector="shingle", **scoring.CLOUD)
    return scored.drop("shingle").withColumn("score", F.coalesce("score", F.lit(0.0)))


def rcf_secondary_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _secondary(spark, sf_dir)


def rcf_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge = _window_scores(spark, sf_dir).select(*WINDOW, F.col("score").alias("edge_score"))
    found = scoring.adaptive_threshold(_secondary(spark, sf_dir), ["device_id"], ["window_start_ms"]).join(edge, WINDOW)
    more = scoring.improvement(F.col("score"), F.col("edge_score"), F.col("adaptive_threshold"))
    return found.where(F.col("score") > F.col("adaptive_threshold")).select(*WINDOW, "score", F.map_entries(more).alias("metadata"))


def dtw_likeliness(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = Window.partitionBy("measure").orderBy(F.col("sequence_number").desc())
    recent = readings(spark, sf_dir).withColumn("back", F.row_number().over(last)).where("back <= 166")
    series: Column = F.transform(F.array_sort(F.collect_list(F.struct("sequence_number", "score"))), lambda x: x["score"])
    found = recent.groupBy("measure").agg(series.alias("series"))
    return found.select("measure", F.size("series").alias("points"), scoring.likeliness("series").alias("likeliness"))


QUERIES = {
    f.__name__: f
    for f in (
        tumbling_stats, tumbling_offset, sliding_window_stats, score_stats, high_score_windows, window_points_long, window_points_cloud, metadata_numeric_points,
        id_collection, count_window_50, count_sliding_166_20, shingle_vectors, shingle_cyclic, global_anomaly_rate, time_since_last_anomaly, p99_index, adaptive_threshold,
        feature_vectors, rcf_edge_scores, rcf_secondary_scores, rcf_alerts, dtw_likeliness,
    )
}

_DAILY = f"""{SQL}, w AS (
  SELECT *, edge_ms - edge_ms % {DAY_MS} AS window_start_ms, edge_ms - edge_ms % {DAY_MS} + {DAY_MS} AS window_end_ms FROM e
)"""

_STATS = f"""{_DAILY}, g AS (
  SELECT *, power(value - avg(value) OVER (PARTITION BY device_id, measure, window_start_ms ORDER BY edge_ms, sequence_number ROWS UNBOUNDED PRECEDING), 2) AS gap FROM w
), s AS (
  SELECT device_id, measure, window_start_ms, window_end_ms, count(*) AS count, sum(value) AS sum, min(value) AS min, max(value) AS max, avg(value) AS avg,
         avg(gap) AS variance, sqrt(avg(gap)) AS std_dev, first(value ORDER BY edge_ms, sequence_number) AS first, last(value ORDER BY edge_ms, sequence_number) AS last
  FROM g GROUP BY ALL
)"""

_SCORES = f"""{_STATS}, c AS (
  SELECT device_id, measure, window_start_ms, window_end_ms, count(*) AS count, sum(score) AS sum, min(score) AS min, max(score) AS max, avg(score) AS avg,
         first(edge_ms ORDER BY score DESC, edge_ms, sequence_number) AS max_timestamp_ms, count(*) FILTER (WHERE score > {THRESHOLD}) AS anomaly_count
  FROM w GROUP BY ALL
)"""

_WHOLE = f"""{_DAILY}, h AS (
  SELECT device_id, window_start_ms, window_end_ms, count(*) AS message_count, max(score) AS score, count(*) FILTER (WHERE score > {THRESHOLD}) AS anomaly_count,
         count(DISTINCT measure) AS groups FROM w GROUP BY ALL
), t AS (
  SELECT *, coalesce(window_end_ms - last_value(CASE WHEN anomaly_count > 0 THEN window_end_ms END IGNORE NULLS)
         OVER (PARTITION BY device_id ORDER BY window_end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), {scoring.NEVER_MS}) AS since FROM h
)"""


def _long(rows: list[tuple[str, str, str]], table: str, dims: str, named: bool = True) -> str:
    name = "measure || '_' || '{}'" if named else "'{}'"
    return " UNION ALL ".join(f"SELECT {dims}, {name.format(n)} AS measure_name, '{t}' AS measure_value_type, round(({v})::DOUBLE, 6) AS measure_value, window_end_ms AS time FROM {table}" for n, t, v in rows)


_STAT_ROWS = [("avg", "DOUBLE", "avg"), ("max", "DOUBLE", "max"), ("min", "DOUBLE", "min"), ("stddev", "DOUBLE", "std_dev")]
_SCORE_ROWS = [("score_max", "DOUBLE", "max"), ("score_avg", "DOUBLE", "avg"), ("anomaly_count", "BIGINT", "anomaly_count")]
_ID = "device_id, device_id || '_' || window_start_ms || '_' || window_end_ms AS window_id"
_FEATURES = ", ".join(
    f"round(coalesce(max(CASE WHEN measure = '{m}' THEN {v} END), 0.0), 6) AS s{3 * i + j}" for i, m in enumerate(MEASURES) for j, v in enumerate(("avg", "std_dev", "(last - first) / count"))
)

ORACLES = {
    "tumbling_stats": f"""WITH {_STATS} SELECT device_id, measure, window_start_ms, window_end_ms, count, round(sum, 6) AS sum, min, max, round(avg, 6) AS avg,
        round(variance * {GRID}) / {GRID} AS variance, round(std_dev * {GRID}) / {GRID} AS std_dev, first, last FROM s""",
    "tumbling_offset": f"""WITH {SQL} SELECT device_id, edge_ms - (edge_ms - {6 * HOUR_MS}) % {DAY_MS} AS window_start_ms, count(*) AS messages, max(value) AS max_value FROM e GROUP BY ALL""",
    "sliding_window_stats": f"""WITH {_DAILY}, d AS (SELECT * FROM w UNION ALL SELECT * REPLACE (window_start_ms - {DAY_MS} AS window_start_ms) FROM w)
        SELECT measure, window_start_ms, count(*) AS messages, round(avg(value), 6) AS mean FROM d GROUP BY ALL""",
    "score_stats": f"""WITH {_SCORES} SELECT device_id, measure, window_start_ms, window_end_ms, count, round(sum, 6) AS sum, round(min, 6) AS min, round(max, 6) AS max, round(avg, 6) AS avg,
        max_timestamp_ms, anomaly_count, {THRESHOLD}::DOUBLE AS threshold, round(anomaly_count::DOUBLE / count, 6) AS anomaly_ratio FROM c""",
    "high_score_windows": f"""WITH {_SCORES} SELECT device_id, window_start_ms, window_end_ms, count(*)::INT AS groups FROM c GROUP BY ALL HAVING max(max) > 2.0""",
    "window_points_long": f"""WITH {_SCORES}, h AS (SELECT device_id, window_start_ms, window_end_ms, count(*) AS message_count FROM w GROUP BY ALL)
        {_long(_STAT_ROWS, "s", "device_id")} UNION ALL {_long(_SCORE_ROWS, "c", "device_id")} UNION ALL
        {_long([("message_count", "BIGINT", "message_count"), ("window_duration_ms", "BIGINT", "window_end_ms - window_start_ms")], "h", "device_id", named=False)}""",
    "window_points_cloud": f"""WITH {_SCORES}, h AS (SELECT device_id, window_start_ms, window_end_ms, count(*) AS message_count FROM w GROUP BY ALL)
        {_long([*_STAT_ROWS, ("count", "BIGINT", "count")], "s", _ID)} UNION ALL {_long([*_SCORE_ROWS, ("anomaly_ratio", "DOUBLE", "anomaly_count::DOUBLE / count")], "c", _ID)} UNION ALL
        {_long([("message_count", "BIGINT", "message_count")], "h", _ID, named=False)}""",
    "metadata_numeric_points": f"""WITH {SQL} SELECT device_id, sequence_number, 'k' AS measure_name, 'DOUBLE' AS measure_value_type, k::DOUBLE AS measure_value, edge_ms AS time FROM e""",
    "id_collection": f"""WITH {_DAILY} SELECT device_id, window_start_ms, window_end_ms, count(*) AS message_count, string_agg(sequence_number::VARCHAR, ',' ORDER BY edge_ms, sequence_number) AS message_ids,
        string_agg(k::VARCHAR, ',' ORDER BY edge_ms, sequence_number) AS keys FROM w GROUP BY ALL""",
    "count_window_50": f"""WITH {SQL}, n AS (SELECT sequence_number, (row_number() OVER (ORDER BY sequence_number) - 1) // 50 AS window_no FROM e)
        SELECT window_no AS window, min(sequence_number) AS first, max(sequence_number) AS last, count(*) AS messages FROM n GROUP BY window_no HAVING count(*) = 50""",
    "count_sliding_166_20": f"""WITH {SQL}, n AS (SELECT device_id, sequence_number, row_number() OVER (PARTITION BY device_id ORDER BY sequence_number) AS n,
        count(*) OVER l AS in_window, avg(value) OVER l AS mean FROM e WINDOW l AS (PARTITION BY device_id ORDER BY sequence_number ROWS 165 PRECEDING))
        SELECT device_id, sequence_number, n, in_window, round(mean, 6) AS mean FROM n WHERE n % 20 = 0""",
    "shingle_vectors": f"""WITH {SQL}, n AS (SELECT device_id, sequence_number, lag(value, 3) OVER o AS s0, lag(value, 2) OVER o AS s1, lag(value, 1) OVER o AS s2, value AS s3
        FROM e WINDOW o AS (PARTITION BY device_id ORDER BY sequence_number)) SELECT * FROM n WHERE s0 IS NOT NULL""",
    "shingle_cyclic": f"""WITH {SQL}, n AS (SELECT device_id, sequence_number, value, row_number() OVER (PARTITION BY device_id ORDER BY sequence_number) AS n FROM e)
        SELECT a.device_id, a.sequence_number, {", ".join(f"max(CASE WHEN (b.n - 1) % 4 = {i} THEN b.value END) AS s{i}" for i in range(4))}
        FROM n a JOIN n b ON a.device_id = b.device_id AND b.n BETWEEN a.n - 3 AND a.n WHERE a.n >= 4 GROUP BY a.device_id, a.sequence_number""",
    "global_anomaly_rate": f"""WITH {_WHOLE} SELECT device_id, window_start_ms, window_end_ms, message_count, anomaly_count, groups, round(avg(anomaly_count::DOUBLE / groups) OVER o, 6) AS global_anomaly_rate,
        count(*) OVER o AS total_windows_processed, (sum(anomaly_count) OVER o)::BIGINT AS total_alerts_generated FROM h WINDOW o AS (PARTITION BY device_id ORDER BY window_start_ms ROWS UNBOUNDED PRECEDING)""",
    "time_since_last_anomaly": f"""WITH {_WHOLE} SELECT device_id, window_start_ms, window_end_ms, since AS time_since_last_anomaly_ms FROM t""",
    "p99_index": f"""WITH {SQL}, r AS (SELECT measure, value, row_number() OVER (PARTITION BY measure ORDER BY value) - 1 AS place, count(*) OVER (PARTITION BY measure) AS n FROM e)
        SELECT measure, n, value AS quantile FROM r WHERE place = floor(n * 0.99::DOUBLE)::BIGINT""",
    "adaptive_threshold": f"""WITH {SQL}, r AS (SELECT device_id, sequence_number, score, list_sort(list(score) OVER (PARTITION BY device_id ORDER BY edge_ms, sequence_number ROWS 49 PRECEDING)) AS recent FROM e),
        t AS (SELECT *, CASE WHEN len(recent) < 20 THEN 0.7::DOUBLE ELSE greatest(0.7::DOUBLE, 0.9::DOUBLE * recent[floor(len(recent) * 0.99::DOUBLE)::INT + 1]) END AS threshold FROM r)
        SELECT device_id, sequence_number, round(threshold, 6) AS adaptive_threshold, score > threshold AS triggered FROM t""",
    "feature_vectors": f"""WITH {_STATS}, h AS (SELECT device_id, window_start_ms, window_end_ms, count(*) AS message_count, max(score) AS score, count(*) FILTER (WHERE score > {THRESHOLD}) AS anomaly_count FROM w GROUP BY ALL),
        t AS (SELECT *, least({100 * DAY_MS}, coalesce(window_end_ms - last_value(CASE WHEN anomaly_count > 0 THEN window_end_ms END IGNORE NULLS)
        OVER (PARTITION BY device_id ORDER BY window_end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), {scoring.NEVER_MS})) AS since FROM h)
        SELECT s.device_id, s.window_start_ms, s.window_end_ms, {_FEATURES}, round(max(t.score), 6) AS s15, max(t.message_count)::DOUBLE AS s16, max(t.since)::DOUBLE AS s17
        FROM s JOIN t ON s.device_id = t.device_id AND s.window_start_ms = t.window_start_ms GROUP BY s.device_id, s.window_start_ms, s.window_end_ms""",
}
