import json
import os
import random
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from riverglass.operators import outbox, quality, scoring
from riverglass.sources import queue, readers, simulator
from riverglass.streaming import jobs, sinks
from riverglass.streaming.config import Config, parse_arguments


@pytest.fixture
def collected():
    rows = []
    return rows, lambda df, batch: rows.extend(df.collect())


def _written(spark, tmp_path, n=60):
    df = simulator.messages(spark, n, 2, anomalies=0.05)
    df = df.unionByName(simulator.duplicates(df, 10))
    lines = [r.value for r in df.select(F.to_json(F.struct("device_id", "sequence_number", "edge_timestamp_ms", "idempotency_key", "measurements")).alias("value")).collect()]
    return lines


def _folder(tmp_path, *batches):
    """A folder of text files, one a batch, in this order."""
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    for k, lines in enumerate(batches):
        file = folder / f"{len(list(folder.iterdir())):03}.txt"
        file.write_text("".join(f"{x}\n" for x in lines))
        os.utime(file, (1_000_000 + k, 1_000_000 + k))
    return str(folder)


def _message(at, device="device-0", key=None, value=1.0):
    return json.dumps({"device_id": device, "sequence_number": at // 100, "edge_timestamp_ms": at, "idempotency_key": key, "measurements": {f"xmeas_{i}": value for i in range(23, 42)}})


LAST = simulator.START_MS + 10**8


def _tuples(rows, *columns):
    return sorted(tuple(r[c] for c in columns) for r in rows)


def test_stream_scores_equal_batch_scores_over_many_batches(spark, tmp_path, collected):
    rows, sink = collected
    lines, config = _written(spark, tmp_path), Config(trees=4, sample_size=16, edge_watermark="60 seconds")
    random.Random(3).shuffle(lines)  # batches are out of order, within the watermark
    path = _folder(tmp_path, lines[:50], lines[50:90], lines[90:], [_message(LAST)], [_message(LAST + 1)])
    jobs.use_rocksdb(spark)
    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(path)
    jobs.start(jobs.edge_scores(jobs.parse(raw), config), sink, str(tmp_path / "checkpoint"), config, once=True).awaitTermination()
    batch = jobs.edge_scores_batch(jobs.parse(spark.read.text(path)).where(f"edge_timestamp_ms < {LAST}"), config).collect()
    columns = ("device_id", "group", "sequence_number", "is_duplicate", "score")
    found = [r for r in rows if r.edge_timestamp_ms < LAST]
    assert len(found) == 132 * 3 and sum(r.is_duplicate for r in found) == 12 * 3 and {r.processing_stage for r in found} == {"EDGE_PREPROCESSED"}
    assert _tuples(found, *columns[:4]) == _tuples(batch, *columns[:4])
    want = {r[:4]: r[4] for r in (tuple(x[c] for c in columns) for x in batch) if r[4] is not None}
    assert {r[:4]: r[4] for r in (tuple(x[c] for c in columns) for x in found) if r[4] is not None} == pytest.approx(want)


def test_messages_without_a_key_are_no_duplicates(spark, tmp_path, collected):
    rows, sink = collected
    config = Config(trees=2, sample_size=8, edge_watermark="1 second")
    path = _folder(tmp_path, [_message(simulator.START_MS + 100 * i) for i in range(10)], [_message(LAST)], [_message(LAST + 1)])
    assert jobs.edge_batch(jobs.parse(spark.read.text(path)), config).agg(F.sum("count")).first()[0] == 12 * 3
    jobs.use_rocksdb(spark)
    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(path)
    jobs.start(jobs.edge_scores(jobs.parse(raw), config), sink, str(tmp_path / "c"), config, once=True).awaitTermination()
    assert len([r for r in rows if r.edge_timestamp_ms < LAST and not r.is_duplicate and r.score is not None]) == 30


def test_edge_windows_of_a_stream_drop_late_messages(spark, tmp_path, collected):
    rows, sink = collected
    config = Config(trees=2, sample_size=8, window="2 seconds", edge_watermark="1 second")
    lines = [_message(simulator.START_MS + 100 * i, key=str(i)) for i in range(100)]
    late = [_message(simulator.START_MS + 50, key="late")]
    path = _folder(tmp_path, lines, [_message(LAST, key="x")], late, [_message(LAST + 1, key="y")], [_message(LAST + 10**6, key="z")])
    jobs.use_rocksdb(spark)
    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(path)
    query = jobs.start(jobs.edge_windows(jobs.edge_scores(jobs.parse(raw), config), config), sink, str(tmp_path / "c"), config, once=True)
    query.awaitTermination()
    batch = jobs.edge_batch(jobs.parse(spark.createDataFrame([(x,) for x in lines], "value string")), config).collect()
    found = [r for r in rows if r.window_end_ms < LAST - 10_000]
    assert jobs.late_rows(query) >= 1
    assert _tuples(found, "group", "window_start_ms", "count", "anomaly_count") == _tuples(batch, "group", "window_start_ms", "count", "anomaly_count")
    assert sum(r["count"] for r in found) == 300 and {r.group: r.max for r in found} == pytest.approx({r.group: r.max for r in batch}, rel=10)


def test_edge_batch_windows(spark, tmp_path):
    config = Config(trees=2, sample_size=8, window="2 seconds")
    found = jobs.edge_batch(jobs.parse(spark.createDataFrame([(x,) for x in _written(spark, tmp_path)], "value string")), config)
    assert found.agg(F.sum("count")).first()[0] == 60 * 2 * 3 and found.select("group").distinct().count() == 3


def test_a_filter_flags_what_the_keys_flag(spark):
    df = spark.createDataFrame([("d", i, None if i % 5 == 0 else str(i % 40)) for i in range(200)], "device_id string, edge_timestamp_ms bigint, idempotency_key string")
    args = (df, ["device_id"], ["edge_timestamp_ms"], "idempotency_key", "edge_timestamp_ms")
    exact, bloom = (quality.flag_seen(*args, 10_000, capacity).orderBy("edge_timestamp_ms").collect() for capacity in (0, 1000))
    assert [r.is_duplicate for r in exact] == [r.is_duplicate for r in bloom] == [i % 5 > 0 and i >= 40 for i in range(200)]
    assert [r.is_duplicate for r in quality.flag_seen(*args, 30).collect()] == [False] * 200  # forgotten before they come again


def _windows_json(n=40, seed=2):
    """Envelopes of one device's windows: calm but for a few, one sent twice, one under another key with a known message."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        wild = 50.0 if i in (20, 21, 33) else 0.0
        stats = lambda: {"count": 5, "sum": 5.0, "min": 0.0, "max": 2.0, "avg": rng.random() + wild, "variance": 0.1, "std_dev": rng.random() + wild, "first": rng.random(), "last": rng.random() + wild}
        scores = {"count": 5, "sum": 5.0, "min": 0.1, "max": rng.random() + wild, "avg": 0.5, "max_timestamp_ms": 1, "anomaly_count": int(wild > 0), "threshold": 1.0}
        record = {"transaction_id": f"t{i}", "window_id": f"w{i}", "device_id": "d", "window_start_ms": 60_000 * i, "window_end_ms": 60_000 * (i + 1), "message_count": 5, "message_ids": [f"m{i}"], "idempotency_keys": [f"k{i}"]}
        record |= {"aggregated_measurements": {"a": stats(), "b": stats()}, "aggregated_anomaly_scores": {"g": scores}, "metadata": {}}
        out.append(json.dumps(record))
        if i in (3, 9):
            out.append(json.dumps(record | ({"transaction_id": "again"} if i == 3 else {"transaction_id": "other", "message_ids": ["n"], "window_start_ms": record["window_start_ms"] + 1})))
    return out


def test_cloud_job_of_a_stream_equals_the_batch(spark, tmp_path, collected):
    rows, sink = collected
    config = Config(cloud_trees=5, cloud_sample_size=32, shingle=2, secondary_threshold=0.9, cloud_watermark="1 second", near_ms=30_000, far_ms=60_000, cooldown_ms=1000)
    groups, lines = {"g": ["a", "b"]}, _windows_json()
    flush = [json.dumps(json.loads(lines[0]) | {"window_id": f"f{k}", "transaction_id": f"f{k}", "idempotency_keys": [], "message_ids": [f"f{k}"], "window_start_ms": 10**12 + k, "window_end_ms": 10**12 + k + 1, "device_id": "f"}) for k in range(2)]
    path = _folder(tmp_path, lines[:15], lines[15:], flush[:1], flush[1:])
    plain = spark.createDataFrame([(x,) for x in lines], "value string")
    accepted = jobs.accepted_batch(jobs.windows_of(plain), config)
    assert plain.count() == 42 and accepted.count() == 40
    scores = jobs.secondary_scores(accepted, config, groups).orderBy("window_end_ms").collect()
    assert [r.secondary_score for r in scores][:1] == [0.0] and all(r.secondary_score > 0 for r in scores[2:])
    assert scores[20].since == scoring.NEVER_MS and scores[22].since == 60_000 and len(json.dumps(groups)) > 0
    batch = jobs.cloud_alerts(plain, config, groups).collect()
    assert batch and all(r.related_window_ids[0].startswith("w") and r.metadata["secondary_score"] == r.score for r in batch)
    jobs.use_rocksdb(spark)
    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(path)
    jobs.start(jobs.cloud_alerts(raw, config, groups), sink, str(tmp_path / "c"), config, once=True).awaitTermination()
    found = [r for r in rows if r.device_id == "d"]
    assert _tuples(found, "alert_id", "severity", "timestamp_ms") == _tuples(batch, "alert_id", "severity", "timestamp_ms")
    assert {r.alert_id: r.score for r in found} == pytest.approx({r.alert_id: r.score for r in batch})


def test_suppression_and_cooldown_of_a_stream(spark, tmp_path, collected):
    rows, sink = collected
    parts = [[("d", "g", 10_000 + 1_000 * i, 3.2) for i in range(3)], [("d", "g", 13_000, 3.2), ("d", "g", 14_000, 3.2), ("d", "g", 410_000, 1.6)], [("e", "g", 10**9, 5.0)], [("e", "g", 10**9 + 1, 5.0)]]
    kind = "device_id string, `group` string, edge_timestamp_ms bigint, score double"
    for part in parts:
        spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "scores"))
        time.sleep(1.1)  # files are read in the order of their times
    scores = spark.read.parquet(str(tmp_path / "scores"))
    jobs.use_rocksdb(spark)
    stream = jobs.timed(spark.readStream.schema(scores.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "scores")), "edge_timestamp_ms", "1 second")
    found = jobs.finished(jobs.cooled(jobs.suppressed(jobs.score_alerts(stream, Config()), Config()), Config()))
    jobs.start(found, sink, str(tmp_path / "c"), Config(), once=True).awaitTermination()
    told = sorted((r for r in rows if r.device_id == "d"), key=lambda r: r.timestamp_ms)
    assert [r.timestamp_ms for r in told] == [10_000, 410_000] and told[0].notification_channels == ["Console", "Log", "CloudWatch", "SNS"]
    batch = jobs.cooled(jobs.suppressed(jobs.score_alerts(scores.withColumn("event_time", F.timestamp_millis("edge_timestamp_ms")), Config()), Config()), Config())
    assert sorted(r.timestamp_ms for r in batch.where("device_id = 'd'").collect()) == [10_000, 410_000]


def test_queries_are_begun_again(spark, tmp_path):
    class Query:
        def awaitTermination(self):
            if begun[-1] < 3:
                raise OSError("gone")

    begun, waits = [], []
    assert jobs.supervise(lambda: begun.append(len(begun) + 1) or Query(), 5, 10.0, waits.append) == 2 and waits == [10.0, 10.0]
    begun.clear()
    with pytest.raises(OSError, match="gone"):
        jobs.supervise(lambda: begun.append(0) or Query(), 1, 0.0, waits.append)


def test_queue_settings_hold(tmp_path):
    path = str(tmp_path / "q")
    assert queue.create(path, 200, 40) == queue.create(path) == {"most_bytes": 200, "segment_bytes": 40, "on_full": "overwrite_oldest"}
    for i in range(30):
        assert queue.append(path, [f"message {i:04}", "x" * 10]) == 2 * i
    held = queue.read(path, 0, 1000)
    assert held[-1] == (59, "x" * 10) and held[0][0] > 0 and [n for n, _ in held] == list(range(held[0][0], 60))
    assert sum(p.stat().st_size for p in tmp_path.glob("q/0*")) <= 200
    full = str(tmp_path / "full")
    queue.create(full, 50, 40, queue.REJECT)
    queue.append(full, ["x" * 40])
    with pytest.raises(OSError, match="full"):
        queue.append(full, ["y" * 20])


def test_queue_writers_keep_each_others_messages(tmp_path):
    path = str(tmp_path / "q")
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda k: [queue.append(path, [f"{k}-{i}"]) for i in range(20)], range(8)))
    held = queue.read(path, 0, 1000)
    assert [n for n, _ in held] == list(range(160)) and len({x for _, x in held}) == 160


def test_queue_messages_are_stamped(spark, tmp_path, collected):
    rows, sink = collected
    path = str(tmp_path / "q")
    queue.append(path, [json.dumps({"xmeas_1": 1.5, "note": "x"}), "bad", _message(1000, "other")])
    stream = readers.queue_messages(spark, path, "edge-7", start="earliest")
    query = stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).foreachBatch(sink).start()
    query.processAllAvailable()
    query.stop()
    assert [(r.sequence_number, r.device_id) for r in rows] == [(0, "edge-7"), (2, "edge-7")]
    assert rows[0].clock_offset_ms == rows[0].cloud_timestamp_ms - rows[0].edge_timestamp_ms - 5
    assert rows[1].corrected_timestamp_ms == rows[1].edge_timestamp_ms + rows[1].clock_offset_ms and not rows[1].clock_drift_excessive


def test_cloud_stream_reader(spark, tmp_path, collected):
    """A data source in the connector's place sees its options and gives records."""
    rows, sink = collected

    class Reader(SimpleDataSourceStreamReader):
        def __init__(self, options):
            self.options = options

        def initialOffset(self):
            return {"n": 0}

        def read(self, start):
            found = [(json.dumps(self.options, sort_keys=True).encode(),)] if start["n"] == 0 else []
            return iter(found), {"n": 1}

        def readBetweenOffsets(self, start, end):
            return iter([(json.dumps(self.options, sort_keys=True).encode(),)] * (end["n"] - start["n"]))

    class Fake(DataSource):
        @classmethod
        def name(cls):
            return "fake_kinesis"

        def schema(self):
            return "data binary"

        def simpleStreamReader(self, schema):
            return Reader(dict(self.options))

    spark.dataSource.register(Fake)
    query = readers.kinesis_stream(spark, "s", "r", "fake_kinesis", most=7).writeStream.option("checkpointLocation", str(tmp_path / "c")).foreachBatch(sink).start()
    query.processAllAvailable()
    query.stop()
    seen = {k.lower(): v for k, v in json.loads(rows[0].value).items()}
    assert seen["kinesis.streamname"] == "s" and seen["kinesis.startingposition"] == "LATEST" and seen["kinesis.maxrecordsperfetch"] == "7"
    assert set(readers.kinesis_options("s", "r", adaptive=True)) == {"kinesis.streamName", "kinesis.region", "kinesis.getRecordsIntervalMillis"}


def test_queue_resumes_where_it_ended(spark, tmp_path, collected):
    rows, sink = collected
    path = str(tmp_path / "queue")
    spark.dataSource.register(queue.QueueSource)
    assert queue.append(path, ["a", "b"]) == 0 and queue.append(path, ["c"]) == 2

    def run():
        stream = spark.readStream.format("riverglass_queue").option("path", path).option("most", 2).load()
        query = stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).foreachBatch(sink).start()
        query.processAllAvailable()
        query.stop()

    run()
    assert [(r.sequence_number, r.value) for r in rows] == [(0, "a"), (1, "b"), (2, "c")]
    assert queue.append(path, ["d"]) == 3
    run()
    assert [r.value for r in rows] == ["a", "b", "c", "d"] and queue.end(path) == 4


def test_stores_replace_a_batch_that_comes_again(spark, tmp_path):
    df = spark.createDataFrame([("d", "m", "DOUBLE", 1.0, 86_400_000 * i) for i in range(3)], "device_id string, measure_name string, measure_value_type string, measure_value double, time bigint")
    write = sinks.point_store(str(tmp_path / "store"))
    for batch in (0, 0, 1):
        write(df, batch)
    found = sinks.read_points(spark, str(tmp_path / "store"))
    assert found.count() == 6 and sinks.retained(found, 3 * 86_400_000, 1).count() == 2
    sinks.csv_delivery(str(tmp_path / "csv"))(df, 0)
    assert spark.read.option("header", True).csv(str(tmp_path / "csv/batch=0/year=1970/month=01/day=02/hour=00")).count() == 1
    sinks.json_queue(str(tmp_path / "json"))(df, 0)
    assert json.loads(spark.read.text(str(tmp_path / "json/batch=0")).first()[0])["device_id"] == "d"


def test_expired_days_are_dropped(spark):
    sinks.create_store(spark, "river_test", "points")
    rows = [("d", 1.0, "DOUBLE", 0, "2024-01-01", "m"), ("d", 1.0, "DOUBLE", 0, "2024-01-05", "m")]
    spark.createDataFrame(rows, spark.table("river_test.points").schema).write.insertInto("river_test.points")
    assert sinks.drop_expired(spark, "river_test", "points", "2024-01-03") == 1
    assert spark.table("river_test.points").count() == 1
    spark.sql("DROP DATABASE river_test CASCADE")


def test_notifications_and_fan_out(spark):
    rows = [(f"a{i}", i, "HIGH", "t", "x", ["Log", "SNS"] if i % 2 else ["Log"]) for i in range(25)]
    df = spark.createDataFrame(rows, "alert_id string, timestamp_ms bigint, severity string, alert_title string, alert_description string, notification_channels array<string>")
    log, sns = sinks.ListChannel("Log"), sinks.ListChannel("SNS")
    seen = []
    sinks.routed_batch((lambda d: d, sinks.notifications({"Log": log, "SNS": sns})), (lambda d: d.where("timestamp_ms < 3"), lambda d, b: seen.append((d.count(), b))))(df, 4)
    assert [a.timestamp_ms for a in log.alerts] == list(range(25)) and len(sns.alerts) == 12 and seen == [(3, 4)]


def test_a_ledger_says_what_was_sent(spark, tmp_path):
    class Failing:
        name = "SNS"

        def send(self, alert):
            if alert.timestamp_ms % 4 == 1:
                raise OSError("no route")
            return alert.timestamp_ms % 4 != 3

    rows = [(f"a{i}", "d", i, "HIGH", "t", "x", ["Log", "SNS"] if i % 2 else ["Log"]) for i in range(20)]
    df = spark.createDataFrame(rows, "alert_id string, device_id string, timestamp_ms bigint, severity string, alert_title string, alert_description string, notification_channels array<string>")
    write = sinks.notifications({"Log": sinks.ListChannel("Log"), "SNS": Failing()}, 3, str(tmp_path / "ledger"))
    write(df, 0)
    write(df, 0)  # a batch that comes again replaces itself
    ledger = spark.read.parquet(str(tmp_path / "ledger"))
    assert tuple(sinks.delivery_counters(ledger).first()) == (20, 10, 10, 20)
    assert {tuple(r.notified_channels) for r in sinks.notified(df, ledger).collect()} == {("Log",)}


def test_an_outbox_is_replayed(spark, tmp_path):
    store, sent = sinks.OutboxStore(spark, str(tmp_path / "box")), []
    df = spark.createDataFrame([(f"w{i}", 1000 + i, 2.0 if i == 3 else 0.5) for i in range(5)], "window_id string, window_end_ms bigint, max double")

    def offline(df, batch):
        raise RuntimeError("any error")

    write = sinks.send_or_keep(offline, store.keep, lambda: 2000)
    write(df, 0)
    write(df, 0)  # the same batch again adds nothing
    assert store.load().count() == 5
    tick = sinks.replay(store, lambda r: sent.append(r.message_id) or r.message_id != "w0", lambda: 3000, n=2)
    tick(df.limit(0), 0)
    assert sorted(sent) == ["w0", "w3"] and store.load().count() == 4 and len(store._versions()) == 2
    later = sinks.replay(store, lambda r: True, lambda: 100_000, n=10)
    later(df.limit(0), 1)
    assert store.load().count() == 0
    assert outbox.totals(store.load()).first().pending == 0


def test_windows_that_cannot_be_sent_are_kept_and_drained(spark):
    df = spark.createDataFrame([(f"w{i}", i, 2.0 if i == 3 else 0.5) for i in range(5)], "window_id string, window_end_ms bigint, max double")
    kept = []

    def offline(df, batch):
        raise OSError("no route")

    sinks.send_or_keep(offline, lambda d, b: kept.append(d), lambda: 1000)(df, 0)
    sinks.send_or_keep(lambda d, b: None, lambda d, b: kept.append(d), lambda: 1000)(df, 1)
    assert len(kept) == 1
    order = []
    left = sinks.drain(kept[0], 1000, lambda r: order.append(r.message_id) or r.message_id != "w0", n=3)
    assert sorted(order) == ["w0", "w1", "w3"] and {(r.message_id, r.retry_count) for r in left.collect()} == {("w0", 1), ("w2", 0), ("w4", 0)}


def test_config():
    assert parse_arguments(["--trees", "7", "--key-ttl", "1 hour"]) == {"trees": "7", "key_ttl": "1 hour"}
    assert Config.of({"trees": "7", "decay": "0.5"}, {"trees": "9"}) == Config(trees=9, decay=0.5)
    with pytest.raises(ValueError, match="nonsense"):
        Config.of({"nonsense": "1"})
    with pytest.raises(ValueError, match="without a name"):
        parse_arguments(["7"])


def test_process_csv_has_the_fixed_columns(spark, tmp_path):
    (tmp_path / "run.csv").write_text(",".join(["0", "1", "2"] + ["0.5"] * 52) + "\n")
    row = readers.process_csv(spark, str(tmp_path / "run.csv"), header=False).first()
    assert len(row) == 55 and row.xmv_11 == 0.5 and row["sample"] == 2
