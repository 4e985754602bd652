"""Scalar rules of alerts and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A severity's least ratio of score to threshold.
CRITICAL, HIGH, MEDIUM = 3.0, 2.0, 1.5


def severity(ratio: Column) -> Column:
    """LOW to CRITICAL by the ratio of score to threshold."""
    return F.when(ratio >= CRITICAL, "CRITICAL").when(ratio >= HIGH, "HIGH").when(ratio >= MEDIUM, "MEDIUM").otherwise("LOW")


def severity_level(name: Column) -> Column:
    """1 for LOW to 4 for CRITICAL."""
    return F.array_position(F.array(*map(F.lit, ("LOW", "MEDIUM", "HIGH", "CRITICAL"))), name).cast("long")


def backoff_ms(retries: Column, first: int = 1000, most: int = 60_000) -> Column:
    """The wait before a retry, doubled each time up to most."""
    return F.least(F.lit(first) * F.pow(F.lit(2.0), retries), F.lit(float(most))).cast("long")


def corrected_ms(edge_ms: Column, offset_ms: Column) -> Column:
    """The edge time moved by the clock offset, where one is known."""
    return edge_ms + F.coalesce(offset_ms, F.lit(0))


def offset_sample(cloud_ms: Column, edge_ms: Column, latency_ms: Column) -> Column:
    """How far the cloud's clock is ahead, given half the latency in whole milliseconds."""
    return cloud_ms - edge_ms - F.floor(latency_ms / 2).cast("long")


def bloom_bits(n: Column, fpp: Column) -> Column:
    """Bits of a Bloom filter for n keys."""
    return F.ceil(-n * F.log(fpp) / F.lit(0.4804530139182014))  # ln(2) squared


def bloom_hashes(n: Column, bits: Column) -> Column:
    """Hashes of a Bloom filter."""
    return F.ceil(bits / n * F.lit(0.6931471805599453))  # ln(2)


def bloom_fpp(n: Column, bits: Column, hashes: Column) -> Column:
    """The false-positive rate of a filter that holds n keys."""
    return F.pow(1 - F.exp(-hashes * n / bits), hashes)
