"""All registered queries, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alert_queries, quality_queries, store_queries, window_queries

_MODULES = (window_queries, quality_queries, alert_queries, store_queries)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: f for m in _MODULES for name, f in m.QUERIES.items()}

ORACLES: dict[str, str] = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
