"""Event-time, count and row windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Consecutive orders that one task numbers.
BLOCK = 1 << 20


def event_windows(df: DataFrame, size: str, slide: str | None = None, offset: str = "0 seconds", time: str = "edge_ms") -> DataFrame:
    """Add window_start_ms and window_end_ms of each window that holds a row; several where windows slide.

    Works on a stream alike, where time is a timestamp with a watermark.
    """
    at = F.col(time) if dict(df.dtypes)[time] == "timestamp" else F.timestamp_millis(time)
    held = df.withColumn("_window", F.window(at, size, slide or size, offset))
    return held.withColumn("window_start_ms", F.unix_millis("_window.start")).withColumn("window_end_ms", F.unix_millis("_window.end")).drop("_window")


def with_ordinal(df: DataFrame, order: str, ties: Sequence[str] = (), into: str = "ordinal") -> DataFrame:
    """Number all rows from 0 by an integer order.

    Rows are numbered within blocks of the order's values, in parallel, and blocks by the counts before them, so no
    task sees all rows.
    """
    blocked = df.withColumn("_block", F.floor(F.col(order) / BLOCK))
    counts = blocked.groupBy("_block").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_block").orderBy(order, *ties)
    return blocked.join(counts, "_block").withColumn(into, F.col("_before") + F.row_number().over(inside) - 1).drop("_block", "_before")


def count_windows(df: DataFrame, size: int, order: str) -> DataFrame:
    """Global tumbling windows of size rows: window number, first and last order, rows; full ones only."""
    numbered = with_ordinal(df, order).withColumn("window", F.floor(F.col("ordinal") / size))
    found = numbered.groupBy("window").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("messages"))
    return found.where(F.col("messages") == size)


def count_slides(df: DataFrame, size: int, every: int, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """For every so many rows of a key, the count and mean of its last size rows."""
    by = Window.partitionBy(*keys).orderBy(order)
    last = by.rowsBetween(-(size - 1), 0)
    seen = df.withColumn("n", F.row_number().over(by)).withColumn("in_window", F.count("*").over(last)).withColumn("mean", F.avg(value).over(last))
    return seen.where(F.col("n") % every == 0)


def shingles(df: DataFrame, size: int, keys: Sequence[str], order: str, vector: Column, cyclic: bool = False) -> DataFrame:
    """Add shingle: the last size vectors of a key joined, null until there are as many.

    A cyclic shingle has them in the places of a ring that is written round and round.
    """
    by = Window.partitionBy(*keys).orderBy(order)
    held = df.withColumn("_vector", vector).withColumn("_n", F.row_number().over(by))
    held = held.withColumn("_last", F.collect_list("_vector").over(by.rowsBetween(-(size - 1), 0)))
    if cyclic:
        turn = F.col("_n") % size
        held = held.withColumn("_last", F.concat(F.slice("_last", size - turn + 1, turn), F.slice("_last", F.lit(1), size - turn)))
    return held.withColumn("shingle", F.when(F.col("_n") >= size, F.flatten("_last"))).drop("_vector", "_n", "_last")
