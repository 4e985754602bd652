"""Message quality: duplicates, sequences, order, clock samples, window deduplication."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bloom import BloomFilter
from .folds import Step, fold

HOUR_MS = 3_600_000


def flag_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str], into: str = "is_duplicate") -> DataFrame:
    """Add whether an earlier row has the same keys; rows are kept. A row with a null key is nobody's duplicate."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    spread = F.when(~known, F.xxhash64(*order))  # rows without a key need not meet
    first = Window.partitionBy(*keys, spread).orderBy(*order)
    return df.withColumn(into, known & (F.row_number().over(first) > 1))


def seen_step(ttl_ms: int, capacity: int = 0, fpp: float = 0.001, key: str = "idempotency_key", time: str = "edge_timestamp_ms") -> tuple[Callable[[], Any], Step]:
    """A fold that tells whether a row's key was seen in the last ttl_ms, by time; a null key never was.

    With a capacity the state is a Bloom filter, which an empty one replaces near its capacity: bounded, but new keys
    may seem seen, at a rate of fpp.
    """

    def by_filter(state: BloomFilter, row: dict[str, Any]) -> tuple[BloomFilter, dict[str, Any]]:
        if row[key] is None:
            return state, {"is_duplicate": False}
        again = not state.put(str(row[key]))
        return (BloomFilter(capacity, fpp) if state.near_capacity() else state), {"is_duplicate": again}

    def exact(state: dict[Any, int], row: dict[str, Any]) -> tuple[dict[Any, int], dict[str, Any]]:
        if row[key] is None:
            return state, {"is_duplicate": False}
        forget(state, row[time], ttl_ms)
        again = row[key] in state
        if not again:
            state[row[key]] = row[time]
        return state, {"is_duplicate": again}

    return ((lambda: BloomFilter(capacity, fpp)), by_filter) if capacity else (dict, exact)


def forget(state: dict[Any, int], now: int, ttl_ms: int) -> None:
    """Drop what is older than ttl_ms from the front of a state that has the oldest in front."""
    while state:
        first = next(iter(state))
        if now - state[first] <= ttl_ms:
            return
        del state[first]


def flag_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str], key: str, time: str, ttl_ms: int, capacity: int = 0) -> DataFrame:
    """Add is_duplicate by seen_step(), as streams do; exact without a capacity."""
    init, step = seen_step(ttl_ms, capacity, key=key, time=time)
    return fold(df, keys, order, init, step, "is_duplicate boolean", [key, time])


def drop_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key."""
    return flag_duplicates(df, keys, order, "_again").where(~F.col("_again")).drop("_again")


def sequence_gaps(df: DataFrame, keys: Sequence[str], order: Sequence[str], sequence: str = "sequence_number") -> DataFrame:
    """Add sequence_gap: how many numbers a row is past the one that was due, null where it is the one or the first."""
    before = F.lag(sequence).over(Window.partitionBy(*keys).orderBy(*order))
    gap = F.col(sequence) - (before + 1)
    return df.withColumn("sequence_gap", F.when(gap != 0, gap))


def validate_sequence(df: DataFrame, keys: Sequence[str], order: Sequence[str], sequence: str = "sequence_number") -> DataFrame:
    """Add sequence_valid: whether a row's number is above all before it; the last valid one is the largest so far."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("sequence_valid", F.coalesce(F.col(sequence) > F.max(sequence).over(before), F.lit(True)))


def flag_ties(df: DataFrame, keys: Sequence[str], order: Sequence[str], time: str = "edge_ms") -> DataFrame:
    """Add out_of_order: whether a row's time isn't after the one before it, in order of time."""
    before = F.lag(time).over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("out_of_order", F.coalesce(F.col(time) <= before, F.lit(False)))


def suspect_windows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per window: rows, duplicate_count, out_of_order_count and whether either makes it suspect."""
    counts = df.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.count_if("is_duplicate").alias("duplicate_count"), F.count_if(F.col("out_of_order") | ~F.col("sequence_valid")).alias("out_of_order_count")
    )
    return counts.withColumn("is_suspect_window", (F.col("duplicate_count") > 0) | (F.col("out_of_order_count") > 0))


def within_horizon(df: DataFrame, keys: Sequence[str], order: Sequence[str], horizon_ms: int, time: str = "edge_ms") -> DataFrame:
    """Add is_repeat: whether a row with the same keys, itself no repeat, came at most horizon_ms before."""

    def step(last: int | None, row: dict[str, Any]) -> tuple[int | None, dict[str, Any]]:
        repeat = last is not None and row[time] - last <= horizon_ms
        return (last if repeat else row[time]), {"is_repeat": repeat}

    return fold(df, keys, order, lambda: None, step, "is_repeat boolean", [time])


def accept_step(ttl_ms: int | None, transaction: str | None = None) -> Step:
    """A fold over windows (window_key, idempotency_keys, window_end_ms) that tells whether a window is new.

    It is if neither its key, nor any of its idempotency keys, nor its transaction is known; null ones never are. Only
    accepted windows make theirs known. What is known is forgotten after ttl_ms, which bounds the state.
    """

    def step(state: dict[str, int], row: dict[str, Any]) -> tuple[dict[str, int], dict[str, Any]]:
        now = row["window_end_ms"]
        own = [f"w:{row['window_key']}", *(f"k:{k}" for k in row["idempotency_keys"] if k is not None)]
        if transaction and row[transaction] is not None:
            own.append(f"t:{row[transaction]}")
        accepted = not any(k in state and (ttl_ms is None or now - state[k] <= ttl_ms) for k in own)
        if accepted:
            for k in own:
                state.pop(k, None)
                state[k] = now
            if ttl_ms is not None:
                forget(state, now, ttl_ms)
        return state, {"accepted": accepted}

    return step


def accept_windows(windows: DataFrame, ttl_ms: int | None = 24 * HOUR_MS, device: str = "device_id", transaction: str | None = None) -> DataFrame:
    """Add accepted, by accept_step() over a device's windows in order of start."""
    reads = ["window_key", "idempotency_keys", "window_end_ms", *([transaction] if transaction else [])]
    return fold(windows, [device], ["window_start_ms", "window_key"], dict, accept_step(ttl_ms, transaction), "accepted boolean", reads)


def out_of_order_windows(windows: DataFrame, device: str = "device_id", arrival: str = "arrival") -> DataFrame:
    """Add is_out_of_order: whether a window starts before the largest end that arrived before it."""
    before = Window.partitionBy(device).orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    return windows.withColumn("is_out_of_order", F.coalesce(F.col("window_start_ms") < F.max("window_end_ms").over(before), F.lit(False)))


def receipt(metadata: Column, received_ms: Column) -> Column:
    """Metadata with the time of receipt and that deduplication let the window pass."""
    return F.map_concat(metadata, F.create_map(F.lit("cloud_received_timestamp_ms"), received_ms.cast("string"), F.lit("cloud_dedup_passed"), F.lit("true")))


def sample_clock(df: DataFrame, keys: Sequence[str], order: Sequence[str], interval_ms: int = 60_000, ready: int = 10, time: str = "edge_ms") -> DataFrame:
    """Add sampled: every row until ready samples are there, then one whenever interval_ms has passed since the last."""

    def step(state: tuple[int, int], row: dict[str, Any]) -> tuple[tuple[int, int], dict[str, Any]]:
        n, last = state
        sampled = n < ready or row[time] - last > interval_ms
        return ((n + 1, row[time]) if sampled else state), {"sampled": sampled}

    return fold(df, keys, order, lambda: (0, 0), step, "sampled boolean", [time])


def excessive_drift(edge_ms: Column, offset_ms: Column, now_ms: Column, limit: int = 5000) -> Column:
    """Whether the corrected edge time is more than limit away from now."""
    return F.abs(now_ms - (edge_ms + offset_ms)) > limit
