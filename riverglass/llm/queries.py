"""The queries of the corpus operators, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, source_mix
from .exact_dedup import op7_exact_dedup
from .jaccard_join import op6_jaccard_join
from .license_scan import op1_license_scan
from .line_dedup import op4_line_dedup
from .media_columns import op2_media_columns
from .quality_classifier import op9_quality_classifier
from .secret_scan import op3_secret_scan
from .sentence_pieces import op8_sentence_pieces
from .source_mix import op5_source_mix
from .token_store import op10_token_store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_media_columns": op2_media_columns,
    "op3_secret_scan": op3_secret_scan,
    "op4_line_dedup": op4_line_dedup,
    "op5_source_mix": op5_source_mix,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_sentence_pieces": op8_sentence_pieces,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_token_store": op10_token_store,
}

ORACLES: dict[str, str] = {
    "op5_source_mix": source_mix.ORACLE_SQL,
    "op7_exact_dedup": exact_dedup.ORACLE_SQL,
}
