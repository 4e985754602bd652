"""Anomaly scores: forests over keyed streams, features, adaptive thresholds, pattern match."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .folds import Step, fold
from .forest import Forest

#: Time since an anomaly that never was.
NEVER_MS = 10**15

EDGE = {"trees": 50, "size": 128, "decay": 7.8125e-4, "seed": 42}
CLOUD = {"trees": 100, "size": 256, "decay": 1e-4, "seed": 42}


class Scorer(Protocol):
    """What scores a point by those that it has learnt, and learns one."""

    def score(self, point: Sequence[float]) -> float: ...

    def update(self, point: Sequence[float]) -> None: ...


def score_step(make: Callable[[], Scorer], vector: str = "vector", into: str = "score") -> Step:
    """A fold that scores each vector, then learns it; null for a null vector or a row with is_duplicate.

    A null element counts as 0. A vector of another length than the key's first scores 0 and is not learnt.
    """

    def step(state: tuple[Scorer, int] | None, row: dict[str, Any]) -> tuple[Any, dict[str, Any]]:
        if row[vector] is None or row.get("is_duplicate"):
            return state, {into: None}
        point = tuple(float(x or 0.0) for x in row[vector])
        if state is None:
            state = make(), len(point)
        if len(point) != state[1]:
            return state, {into: 0.0}
        found = state[0].score(point)
        state[0].update(point)
        return state, {into: found}

    return step


def forest_scores(df: DataFrame, keys: Sequence[str], order: Sequence[str], vector: str = "vector", into: str = "score", make: Callable[[], Scorer] | None = None, **forest: Any) -> DataFrame:
    """Add each vector's score by its key's forest, or by what make() gives, which then learns it; see score_step()."""
    settings = EDGE | forest
    return fold(df, keys, order, lambda: None, score_step(make or (lambda: Forest(**settings)), vector, into), f"{into} double", [vector])


def features(stats: DataFrame, keys: Sequence[str], measures: Sequence[str], score_max: str, message_count: str, since: str) -> DataFrame:
    """Per window the vector of avg, std_dev and trend of each measure (0 where missing), then the three others.

    stats has a row for each measure of a window; the trend is (last - first) / count.
    """
    trend = (F.col("last") - F.col("first")) / F.col("count")

    def of(measure: str, value: Column) -> Column:
        return F.coalesce(F.max(F.when(F.col("measure") == measure, value)), F.lit(0.0))

    parts = [of(m, v) for m in measures for v in (F.col("avg"), F.col("std_dev"), trend)]
    found = stats.groupBy(*keys).agg(*[p.alias(f"f{i}") for i, p in enumerate(parts)], F.max(score_max).alias("edge_score"), F.max(message_count).alias("n"), F.max(since).alias("since"))
    vector = F.array(*[F.col(f"f{i}") for i in range(len(parts))], F.coalesce("edge_score", F.lit(0.0)), F.col("n").cast("double"), F.col("since").cast("double"))
    return found.select(*keys, vector.alias("vector"))


def time_since_anomaly(windows: DataFrame, keys: Sequence[str], end: str = "window_end_ms", anomalies: str = "anomaly_count") -> DataFrame:
    """Add time_since_last_anomaly_ms: from the end of the last earlier window with an anomaly, NEVER_MS without one."""
    before = Window.partitionBy(*keys).orderBy(end).rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col(anomalies) > 0, F.col(end)), ignorenulls=True).over(before)
    return windows.withColumn("time_since_last_anomaly_ms", F.coalesce(F.col(end) - last, F.lit(NEVER_MS)))


def adaptive_threshold(scores: DataFrame, keys: Sequence[str], order: Sequence[str], base: float = 1.5, share: float = 0.99, factor: float = 0.9, size: int = 1000, warm_up: int = 100, score: str = "score") -> DataFrame:
    """Add adaptive_threshold: the larger of base and factor times the share-quantile of a key's last size scores.

    The current score counts; before warm_up scores the threshold is base. The quantile is the value at place
    floor(n * share). A key's state is its last size scores, in order of time and sorted.
    """

    def step(state: tuple[deque, list], row: dict[str, Any]) -> tuple[Any, dict[str, Any]]:
        return state, {"adaptive_threshold": _threshold(*state, row[score], base, share, factor, size, warm_up)}

    return fold(scores, keys, order, lambda: (deque(), []), step, "adaptive_threshold double", [score])


def _threshold(last: deque, ranked: list, score: float, base: float, share: float, factor: float, size: int, warm_up: int) -> float:
    last.append(score)
    insort(ranked, score)
    if len(last) > size:
        del ranked[bisect_left(ranked, last.popleft())]
    return base if len(last) < warm_up else max(base, factor * ranked[int(len(last) * share)])


def secondary_step(
    shingle: int = 4, base: float = 1.5, share: float = 0.99, factor: float = 0.9, history: int = 1000, warm_up: int = 100, size_of_sample: int = CLOUD["size"], **forest: Any
) -> tuple[Callable[[], Any], Step]:
    """A fold over a device's and group's windows (vector, window_end_ms, anomaly_count): since, secondary_score, adaptive_threshold.

    The point is the vector and the time since the last earlier window with an anomaly; the last few points, in the
    places of a ring, are scored by a forest, 0 until there are enough; the threshold follows the scores.
    """
    settings = CLOUD | forest | {"size": size_of_sample}

    def step(state: dict[str, Any], row: dict[str, Any]) -> tuple[dict[str, Any], dict[str, Any]]:
        since = NEVER_MS if state["last"] is None else row["window_end_ms"] - state["last"]
        point = [*(float(x or 0.0) for x in row["vector"]), float(since)]
        state["ring"][state["n"] % shingle] = point
        state["n"] += 1
        score = 0.0
        if state["n"] >= shingle:
            whole = tuple(x for p in state["ring"] for x in p)
            state["forest"] = state["forest"] or Forest(**settings)
            score = state["forest"].score(whole)
            state["forest"].update(whole)
        threshold = _threshold(*state["scores"], score, base, share, factor, history, warm_up)
        if row["anomaly_count"] > 0:
            state["last"] = row["window_end_ms"]
        return state, {"since": since, "secondary_score": score, "adaptive_threshold": threshold}

    return (lambda: {"ring": [None] * shingle, "n": 0, "forest": None, "scores": (deque(), []), "last": None}), step


SECONDARY = "since bigint, secondary_score double, adaptive_threshold double"


def secondary_scores(windows: DataFrame, keys: Sequence[str] = ("device_id", "group"), order: Sequence[str] = ("window_end_ms",), **settings: Any) -> DataFrame:
    """Add since, secondary_score and adaptive_threshold by secondary_step()."""
    init, step = secondary_step(**settings)
    return fold(windows, keys, order, init, step, SECONDARY, ["vector", "window_end_ms", "anomaly_count"])


def group_features(windows: DataFrame, groups: dict[str, list[str]], keep: Sequence[str]) -> DataFrame:
    """A row for each window and group with edge scores: group, vector, edge_score and anomaly_count.

    windows has aggregated_measurements, aggregated_anomaly_scores and message_count. The vector is each measure's
    avg, std_dev and trend ((last - first) / count), 0 where missing, then the largest edge score and message_count.
    """
    stats, scores = F.col("aggregated_measurements"), F.col("aggregated_anomaly_scores")

    def vector(group: str, measures: Sequence[str]) -> Column:
        out = []
        for m in measures:
            s = F.try_element_at(stats, F.lit(m))
            out += [F.coalesce(x, F.lit(0.0)) for x in (s["avg"], s["std_dev"], (s["last"] - s["first"]) / s["count"])]
        return F.array(*out, F.try_element_at(scores, F.lit(group))["max"], F.col("message_count").cast("double"))

    entries = [F.struct(F.lit(g).alias("group"), vector(g, m).alias("vector"), F.try_element_at(scores, F.lit(g)).alias("edge")) for g, m in groups.items()]
    found = windows.select(*keep, F.explode(F.array(*entries)).alias("g")).where("g.edge is not null")
    return found.select(*keep, "g.group", "g.vector", F.col("g.edge.max").alias("edge_score"), F.col("g.edge.anomaly_count").alias("anomaly_count"))


def improvement(row_score: Column, edge_score: Column, threshold: Column) -> Column:
    """Alert metadata on how the second score compares with the first."""
    pairs = {"secondary_score": row_score, "edge_score": edge_score, "adaptive_threshold": threshold, "score_improvement": row_score - edge_score}
    return F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v)])


def spike(size: int = 166) -> list[float]:
    """A pattern to look for: calm, a steep rise to 3 in the middle third, and a slow fall."""
    third = size // 3
    return [1.0] * third + [1 + 2 * k / third for k in range(third)] + [3 - 2 * k / (size - 2 * third) for k in range(size - 2 * third)]


def dtw(a: Sequence[float], b: Sequence[float], radius: int = 50) -> float:
    """The dynamic time warping distance, by absolute differences, within radius of the diagonal."""
    x, y = np.asarray(a, float), np.asarray(b, float)
    above = np.full(len(y) + 1, np.inf)
    above[0] = 0.0
    for i in range(1, len(x) + 1):
        centre = i * len(y) / len(x)
        low, high = max(1, int(centre) - radius), min(len(y), int(centre) + radius)
        cost = np.abs(y[low - 1 : high] - x[i - 1])
        enter = np.minimum(above[low : high + 1], above[low - 1 : high]) + cost
        # a row's value is the least, over where the row is entered, of entering there and walking on
        walked = np.cumsum(cost)
        row = np.full(len(y) + 1, np.inf)
        row[low : high + 1] = np.minimum.accumulate(enter - walked) + walked
        above = row
    return float(above[-1])


def likeliness(series: str, pattern: Sequence[float] | None = None, radius: int = 50) -> Column:
    """100 / distance of a series column to the pattern, 0 for a shorter series or a distance of 0 or 10 million and more."""
    want = list(pattern or spike())

    def one(values: Any) -> float:
        if values is None or len(values) < len(want):
            return 0.0
        d = dtw(values, want, radius)
        return 100.0 / d if 0 < d < 1e7 else 0.0

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            yield values.map(one)

    return scored(F.col(series))
