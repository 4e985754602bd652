import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riverglass.operators import scoring
from riverglass.operators.forest import Forest


def _points(n, seed, dims=3):
    rng = random.Random(seed)
    return [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(n)]


def _scores(points, **settings):
    forest, out = Forest(**settings), []
    for p in points:
        out.append(forest.score(p))
        forest.update(p)
    return out, forest


def test_forest_is_deterministic_and_not_negative():
    a, _ = _scores(_points(300, 1), trees=10, size=32)
    assert a == _scores(_points(300, 1), trees=10, size=32)[0] and min(a) >= 0


def test_forest_ranks_a_spike_first():
    points = _points(300, 2)
    points[250] = [9.0, -9.0, 9.0]
    scores, _ = _scores(points, trees=30, size=64)
    assert int(np.argmax(scores[100:])) + 100 == 250


def test_trees_hold_their_samples():
    _, forest = _scores(_points(200, 3) + [[1.0, 1.0, 1.0]] * 50, trees=8, size=40)

    def check(node):
        if node.cut is None:
            return node.size
        assert node.size == check(node.left) + check(node.right)
        assert (node.low == np.minimum(node.left.low, node.right.low)).all() and (node.high == np.maximum(node.left.high, node.right.high)).all()
        assert node.left.high[node.dim] <= node.cut < node.right.low[node.dim] + 1e-9
        return node.size

    assert {check(t.root) for t in forest.trees} == {40}


def test_forest_scores_as_a_walk_of_its_nodes():
    def walk(node, p, depth=0):
        if node.cut is None:
            return 1 / (depth + np.log2(node.size + 1)) if (node.low == p).all() else 1 / (depth + 1)
        outside = sum(max(a - x, x - b, 0.0) for a, x, b in zip(node.low, p, node.high, strict=True))
        parted = outside / (outside + (node.high - node.low).sum())
        return parted / (depth + 1) + (1 - parted) * walk(node.left if p[node.dim] <= node.cut else node.right, p, depth + 1)

    points = _points(120, 4) + [[1.0, 0.0, 1.0]] * 10
    _, forest = _scores(points, trees=6, size=32)
    for p in [*points[-20:], [5.0, 5.0, 5.0]]:
        assert forest.score(p) == pytest.approx(np.mean([walk(t.root, p) for t in forest.trees]) * np.log2(33))


@pytest.mark.parametrize("size", [1, 2, 17])
def test_forest_takes_equal_close_and_odd_points(size):
    close = float(np.nextafter(1.0, 2.0))
    rng = random.Random(5)
    points = [rng.choice([[1.0, 0.0], [close, 0.0], [1.0, -0.0], [float("nan"), 1e300], [float("inf"), 2.0], [3.0, 4.0]]) for _ in range(300)]
    scores, forest = _scores(points, trees=5, size=size)
    assert np.isfinite(scores).all() and min(scores) >= 0

    def leaves(node):
        return [(tuple(node.low), node.size)] if node.cut is None else leaves(node.left) + leaves(node.right)

    for t in forest.trees:
        held = leaves(t.root)
        assert sum(n for _, n in held) == size == t.root.size and len({p for p, _ in held}) == len(held)


def test_forest_scores_by_key_in_order(spark):
    rows = [(k, i, p) for k in range(3) for i, p in enumerate(_points(60, k))]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "k int, i int, vector array<double>")
    found = {(r.k, r.i): r.score for r in scoring.forest_scores(df, ["k"], ["i"], trees=5, size=16).collect()}
    for k in range(3):
        assert [found[k, i] for i in range(60)] == pytest.approx(_scores(_points(60, k), trees=5, size=16, decay=scoring.EDGE["decay"])[0])


def test_forest_handles_nulls_and_other_lengths(spark):
    df = spark.createDataFrame([(1, 1, [1.0]), (1, 2, None), (1, 3, [1.0, 2.0]), (1, 4, [None])], "k int, i int, vector array<double>")
    assert [r.score for r in scoring.forest_scores(df, ["k"], ["i"], trees=2, size=4).orderBy("i").collect()][1:3] == [None, 0.0]


def test_dtw_is_the_banded_recurrence():
    rng = np.random.default_rng(5)
    for n, m, radius in ((20, 20, 4), (31, 17, 9), (5, 40, 50)):
        a, b = rng.random(n), rng.random(m)
        table = np.full((n + 1, m + 1), np.inf)
        table[0, 0] = 0
        for i in range(1, n + 1):
            centre = int(i * m / n)
            for j in range(max(1, centre - radius), min(m, centre + radius) + 1):
                table[i, j] = abs(a[i - 1] - b[j - 1]) + min(table[i - 1, j], table[i - 1, j - 1], table[i, j - 1])
        assert scoring.dtw(a, b, radius) == pytest.approx(table[n, m])


def test_likeliness(spark):
    pattern = scoring.spike()
    df = spark.createDataFrame([(1, pattern), (2, pattern[:-1]), (3, [x + 0.5 for x in pattern]), (4, None)], "id int, series array<double>")
    found = {r.id: r.x for r in df.select("id", scoring.likeliness("series").alias("x")).collect()}
    assert found[1] == 0 and found[2] == 0 and found[4] == 0 and found[3] > 0


def test_time_since_anomaly(spark):
    df = spark.createDataFrame([(1, 10, 0), (1, 20, 2), (1, 30, 0), (1, 40, 1)], "device_id int, window_end_ms bigint, anomaly_count bigint")
    found = scoring.time_since_anomaly(df, ["device_id"]).orderBy("window_end_ms").select(F.col("time_since_last_anomaly_ms")).collect()
    assert [r[0] for r in found] == [scoring.NEVER_MS, scoring.NEVER_MS, 10, 20]
