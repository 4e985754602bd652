"""A training corpus from documents: bad texts go, repeated lines and near copies go, sources are mixed, texts encoded.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept; all but the last return
the columns of documents. Null ids, texts and sources, empty and very long texts, rows that repeat, empty tables and
further columns whatever their names have the results that the operators state; no stage needs an id to be unique.
Every stage's rows are written to the folder that driver and executors share, and read again, so what a lost executor
held is read or computed again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverglass.llm import jaccard_join, line_dedup, quality_classifier, sentence_pieces, source_mix
from riverglass.llm.common import materialize


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, predicts to be good.

    A null or empty text counts as empty; without labels all weights are 0 and all documents stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.keep_good(docs, quality_classifier.fit(docs, labels))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, later ones without the blocks of lines that they share with earlier ones, and n_chars counted again.

    A null text stays null, and so does its count; a text may become empty.
    """
    found = line_dedup.line_dedup(docs)
    names = found.columns
    if "n_chars" not in names:
        return found
    at, kind = names.index("n_chars"), found.schema[names.index("n_chars")].dataType
    plain = found.toDF(*[f"c{i}" for i in range(len(names))])  # by place, as names may differ in case alone
    return plain.withColumn(f"c{at}", F.length(f"c{names.index('text')}").cast(kind)).toDF(*names)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near copies; texts without words, null ones too, are one class."""
    return jaccard_join.keep_one(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, a null source being one; texts without words add nothing to it."""
    return source_mix.mixed(docs)


def encoded_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document's text, and the text that they decode to; a null text has none, and an empty text."""
    found = sentence_pieces.encode_pieces(docs, keep=("lang", "source"))
    return found.select("doc_id", "lang", "source", "n_pieces", "ids", "ids_crc32", "decoded")


STAGES = [
    ("quality classifier", good_texts),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_near_copies),
    ("source mix", mixed_sources),
    ("sentence pieces", encoded_texts),
]

#: Training, alignment and encoding are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each but the last is written and read again. An empty table gives an empty one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
