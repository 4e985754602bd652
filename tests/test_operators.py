import random

import pytest
from pyspark.sql import functions as F

from riverglass.functions import parsing, schemas
from riverglass.operators import alerts, outbox, quality, scoring, stats, windows
from riverglass.operators.bloom import BloomFilter
from riverglass.operators.folds import fold
from riverglass.operators.transactions import Coordinator, Status
from riverglass.sources import simulator


def test_streaming_variance_is_the_recurrence(spark):
    rng = random.Random(3)
    rows = [(d, i, i, rng.uniform(-5, 5)) for d in range(3) for i in range(40)]
    df = spark.createDataFrame(rows, "device_id int, edge_ms bigint, sequence_number bigint, value double")
    found = {r.device_id: r for r in stats.measurement_stats(df, ["device_id"]).collect()}
    for d in range(3):
        n, total, var = 0, 0.0, 0.0
        for _, _, _, x in (r for r in rows if r[0] == d):
            n, total = n + 1, total + x
            var = (var * (n - 1) + (x - total / n) ** 2) / n
        assert found[d].variance == pytest.approx(var)
        assert (found[d].first, found[d].last) == (next(r[3] for r in rows if r[0] == d), [r[3] for r in rows if r[0] == d][-1])


def test_null_values_are_skipped(spark):
    df = spark.createDataFrame([(1, 1, 1, None), (1, 2, 2, 4.0)], "device_id int, edge_ms bigint, sequence_number bigint, value double")
    row = stats.measurement_stats(df, ["device_id"]).first()
    assert (row["count"], row["first"], row["variance"]) == (1, 4.0, 0.0)


def test_score_aggregation_case(spark):
    rng = random.Random(1)
    scores = [0.5 + rng.random() / 2 for _ in range(80)] + [1.5 + rng.random() * 2 for _ in range(20)]
    df = spark.createDataFrame([(1, i, i, s) for i, s in enumerate(scores)], "g int, edge_ms bigint, sequence_number bigint, score double")
    row = stats.score_stats(df, ["g"], 1.0).first()
    assert (row["count"], row["anomaly_count"], row["max_timestamp_ms"]) == (100, 20, scores.index(max(scores)))
    assert row["anomaly_ratio"] == 0.2


def test_all_zero_scores_have_a_true_maximum(spark):
    df = spark.createDataFrame([(1, 5, 1, 0.0), (1, 7, 2, 0.0)], "g int, edge_ms bigint, sequence_number bigint, score double")
    row = stats.score_stats(df, ["g"]).first()
    assert (row["max"], row["max_timestamp_ms"]) == (0.0, 5)


def test_clock_estimate_is_near_the_offset(spark):
    rng = random.Random(7)
    rows = [(1, i, int(5000 + rng.gauss(0, 100)) - rng.randrange(50, 100) // 2) for i in range(200)]
    df = spark.createDataFrame(rows, "device_id int, sequence_number bigint, offset_ms bigint")
    found = stats.rolling_offsets(df, ["device_id"], "sequence_number").orderBy("sequence_number").collect()
    assert abs(found[-1].estimate_ms - 5000) < 500 and found[-1].initialised
    assert [r.initialised for r in found[:10]] == [False] * 9 + [True]


def test_bloom_filter_bounds():
    bloom = BloomFilter(10_000, 0.01)
    fresh = sum(bloom.put(f"key-{i}") for i in range(1000))
    assert fresh >= 980 and not bloom.put("key-7") and "key-7" in bloom
    assert sum(f"other-{i}" in bloom for i in range(1000)) < 20
    assert bloom.expected_fpp() < 0.01 and not bloom.near_capacity()
    bloom.clear()
    assert bloom.count == 0 and "key-7" not in bloom


def test_fold_restarts_at_each_key(spark):
    df = spark.createDataFrame([(k, i) for k in range(5) for i in range(4)], "k int, i int")
    found = fold(df, ["k"], ["i"], lambda: 0, lambda s, row: (s + row["i"], {"total": s + row["i"]}), "total bigint").collect()
    assert all(r.total == r.i * (r.i + 1) // 2 for r in found) and len(found) == 20


def test_fold_of_nothing(spark):
    df = spark.createDataFrame([], "k int, i int")
    assert fold(df, ["k"], ["i"], lambda: 0, lambda s, row: (s, {"total": 0}), "total bigint").count() == 0


def test_only_accepted_windows_become_known(spark):
    rows = [(1, 0, 10, "a", ["x"]), (1, 10, 20, "b", ["x", "y"]), (1, 20, 30, "c", ["y"]), (1, 30, 40, "a", ["z"])]
    df = spark.createDataFrame(rows, "device_id int, window_start_ms bigint, window_end_ms bigint, window_key string, idempotency_keys array<string>")
    found = quality.accept_windows(df, ttl_ms=None).orderBy("window_start_ms").collect()
    assert [r.accepted for r in found] == [True, False, True, False]


def test_known_keys_expire(spark):
    rows = [(1, 0, 10, "a", ["x"]), (1, 10, 20, "b", ["x"]), (1, 100, 110, "c", ["x"])]
    df = spark.createDataFrame(rows, "device_id int, window_start_ms bigint, window_end_ms bigint, window_key string, idempotency_keys array<string>")
    found = quality.accept_windows(df, ttl_ms=50).orderBy("window_start_ms").collect()
    assert [r.accepted for r in found] == [True, False, True]


def test_suppression_rules(spark):
    rows = [(1, 0, 1, 2.0), (1, 30_000, 2, 2.0), (1, 31_000, 3, 3.5), (1, 200_000, 4, 1.2), (1, 400_000, 5, 1.2)]
    df = spark.createDataFrame(rows, "device_id int, timestamp_ms bigint, sequence_number bigint, ratio double")
    assert [r.sequence_number for r in alerts.suppress(df).where("emitted").orderBy("sequence_number").collect()] == [1, 3, 5]


def test_outbox_stops_at_the_first_waiting_message(spark):
    rows = [(f"m{i}", "p", i, i, 990 if i == 3 else 0, int(i == 3), int(i % 3 == 0), True) for i in range(10)]
    df = spark.createDataFrame(rows, schemas.OUTBOX_DDL)
    assert [r.message_id for r in outbox.take(df, 5, 1000).orderBy("message_id").collect()] == ["m0"]
    ready = outbox.take(df, 5, 10_000)
    assert sorted(r.message_id for r in ready.collect()) == ["m0", "m1", "m3", "m6", "m9"]


def test_outbox_case(spark):
    rows = [(f"m{i}", "p", i, i, 0, 0, int(i % 3 == 0), True) for i in range(10)]
    df = spark.createDataFrame(rows, schemas.OUTBOX_DDL)
    taken = [r.message_id for r in outbox.take(df, 5, 1000).collect()]
    assert len(taken) == 5
    confirmed = spark.createDataFrame([(m,) for m in taken[:2]], "message_id string")
    failed = spark.createDataFrame([(m, True) for m in taken[2:]], "message_id string, retry boolean")
    left = outbox.fail(outbox.confirm(df, confirmed), failed, 1000)
    assert left.count() == 8 and left.where("retry_count = 1").count() == 3
    assert outbox.totals(left).first().pending == 8


def test_an_outbox_fills_up_in_order_of_time(spark):
    held = spark.createDataFrame([("old", "x" * 10, 0, 0, 0, 0, 0, True)], schemas.OUTBOX_DDL)
    new = spark.createDataFrame([(f"m{i:02}", "x" * 10, i, 20_000 * i, 0, 0, 0, True) for i in range(20)], schemas.OUTBOX_DDL)
    kept = {r.message_id for r in outbox.store(held, new, most_bytes=95).collect()}
    assert kept == {"old", *(f"m{i:02}" for i in range(9))}


def test_null_keys_are_no_duplicates(spark):
    df = spark.createDataFrame([(1, None, i) for i in range(10)] + [(1, "a", 20), (1, "a", 21)], "device_id int, k string, at int")
    found = quality.flag_duplicates(df, ["device_id", "k"], ["at"]).where("is_duplicate").collect()
    assert [(r.k, r["at"]) for r in found] == [("a", 21)]
    windows = spark.createDataFrame([(1, i, i + 1, f"w{i}", [None]) for i in range(3)], "device_id int, window_start_ms bigint, window_end_ms bigint, window_key string, idempotency_keys array<string>")
    assert quality.accept_windows(windows).where("accepted").count() == 3


def test_quantile_of_a_key_with_ties_and_signs(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice([-5.5, 0.0, 1e9, rng.gauss(0, 3)])) for k in (1, 2, None) for _ in range(500)] + [(3, 2.0), (4, None)]
    found = {r.k: (r.n, r.quantile) for r in stats.index_quantile(spark.createDataFrame(rows, "k int, v double"), ["k"], "v", 0.7).collect()}
    for k in (1, 2, 3, None):
        mine = sorted(v for key, v in rows if key == k)
        assert found[k] == (len(mine), mine[int(len(mine) * 0.7)])
    assert 4 not in found


def test_a_scorer_of_ones_own(spark):
    class Distance:
        def __init__(self):
            self.last = (0.0,)

        def score(self, point):
            return abs(point[0] - self.last[0])

        def update(self, point):
            self.last = point

    df = spark.createDataFrame([(1, i, [float(i * i)]) for i in range(4)], "k int, i int, vector array<double>")
    assert [r.score for r in scoring.forest_scores(df, ["k"], ["i"], make=Distance).orderBy("i").collect()] == [0.0, 1.0, 3.0, 5.0]


def test_outbox_refuses_beyond_its_space(spark):
    empty = spark.createDataFrame([], schemas.OUTBOX_DDL)
    new = spark.createDataFrame([(f"m{i}", "12345", i, i, 0, 0, 0, True) for i in range(4)], schemas.OUTBOX_DDL)
    assert outbox.store(empty, new, most_bytes=10).count() == 2


class _Participant:
    def __init__(self, id_, prepare=True, commit=True):
        self.id, self.ok, self.commits, self.aborted = id_, prepare, commit, False

    def prepare(self, transaction):
        return self.ok

    def commit(self, transaction):
        return self.commits

    def abort(self, transaction):
        self.aborted = True


def test_two_phase_commit():
    now = [0.0]
    c = Coordinator(clock=lambda: now[0])
    good = [_Participant(x) for x in ("source", "processor", "sink")]
    assert c.execute("t1", "1", good)
    bad = [good[0], _Participant("processor", False, False), good[2]]
    assert not c.execute("t2", "2", bad) and all(p.aborted for p in bad)
    assert (c.committed, c.aborted, c.success_rate()) == (1, 1, 0.5)
    assert c.execute("t3", "3", [])
    assert not c.execute("t4", "4", [_Participant("sink", True, False)]) and "t4" in c.active
    now[0] = 301.0
    assert c.sweep() == 1 and c.aborted == 2 and not c.active
    t = c.begin("t5", "5")
    assert t.status is Status.INITIATED and Coordinator().success_rate() == 1.0


def test_messages_survive_json(spark):
    df = simulator.messages(spark, 20, 2, anomalies=0.2)
    back = df.select("*", F.to_json(F.struct(*[c for c in df.columns if c != "is_anomaly"])).alias("json")).withColumn("m", parsing.parse_message(F.col("json")))
    same = back.select([(F.to_json(F.col(f"m.{c}")) if c == "measurements" else F.col(f"m.{c}")).eqNullSafe(F.to_json(c) if c == "measurements" else F.col(c)).alias(c) for c in ("message_id", "device_id", "edge_timestamp_ms", "sequence_number", "measurements")])
    assert all(all(r) for r in same.collect())


def test_flat_objects_fall_back_to_numbers(spark):
    df = spark.createDataFrame([('{"xmeas_1": 1.5, "note": "x", "xmeas_2": 2}',), ("bad",), (None,)], "value string")
    found = df.select(parsing.parse_message(F.col("value"))["measurements"].alias("m")).collect()
    assert found[0].m == {"xmeas_1": 1.5, "xmeas_2": 2.0} and not found[1].m and not found[2].m


def test_simulator_is_deterministic_and_marks_anomalies(spark):
    a, b = (simulator.messages(spark, 200, 1, anomalies=0.3) for _ in range(2))
    texts = [x.withColumn("measurements", F.to_json("measurements")) for x in (a, b)]
    assert texts[0].exceptAll(texts[1]).count() == 0
    assert 30 < a.where("is_anomaly").count() < 90
    assert simulator.duplicates(a, 10).count() == 20 and simulator.out_of_order(a, 10, 500).count() == 20
    assert simulator.drifting(a, 7).agg(F.min("edge_timestamp_ms")).first()[0] == simulator.START_MS + simulator.STEP_MS + 7


def test_ordinals_cross_blocks(spark):
    df = spark.range(0, 50).select((F.col("id") * windows.BLOCK / 5).cast("long").alias("at"))
    assert [r.ordinal for r in windows.with_ordinal(df, "at").orderBy("at").collect()] == list(range(50))


def test_group_vector_is_null_without_any_measure(spark):
    df = spark.sql("SELECT map('xmeas_23', 2.0D) AS a, map('other', 1.0D) AS b")
    names = schemas.group_measures(schemas.SAMPLED_GROUPS)["reactor_feed"]
    row = df.select(parsing.group_vector(F.col("a"), names).alias("a"), parsing.group_vector(F.col("b"), names).alias("b")).first()
    assert row.a == [2.0, 0, 0, 0, 0, 0] and row.b is None
