"""Operator 9, quality classifier: logistic regression over hashed word n-grams, trained by FTRL-proximal updates.

Tokens are words and runs of other visible characters. The n-grams are of one and two tokens, once by their
letters and once by their form (lower case, capitals, a repeat of the token before, or the marks themselves). A
text's value of a feature is its share of all the text's n-grams, so length alone moves no score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, texts, trimmed, tune
from .wordhash import MARK, chunks, cut, mix

BITS = 18
#: Features of a token, and the scale of their shares.
PER_TOKEN, SCALE = 4, 40.0
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.05, 0.01, 4
#: The most labelled rows that training reads, those with the smallest hash of their id.
SAMPLE = 4096

_UPPER = np.zeros(256, np.int32)
_UPPER[0x41:0x5B] = 1
_LOWER_FORM, _UPPER_FORM, _REPEAT_FORM, _START = (np.uint64(x) for x in (11, 12, 13, 14))


def features(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, PER_TOKEN feature indices) of each token of the texts that data holds."""
    starts, stops, words, kinds = cut(data, ends, marks=True)
    text = np.searchsorted(ends, starts, "right")
    first = np.ones(len(text), bool)
    first[1:] = text[1:] != text[:-1]
    capitals = np.concatenate([[0], np.cumsum(_UPPER[data])])
    shapes = np.where(capitals[stops] - capitals[starts] >= 2, _UPPER_FORM, _LOWER_FORM)
    shapes = np.where(kinds == MARK, words, shapes)
    before = np.roll(words, 1)
    shapes = np.where((words == before) & ~first, _REPEAT_FORM, shapes)
    ahead = np.roll(shapes, 1)
    before, ahead = np.where(first, _START, before), np.where(first, _START, ahead)
    mask, three, five = np.uint64((1 << BITS) - 1), np.uint64(3), np.uint64(5)
    found = [words, mix(words * three + before), mix(shapes + five), mix(shapes * five + ahead)]
    return text, np.stack([(x & mask).astype(np.int64) for x in found], axis=1)


def train(examples: list[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
    """Weights, the last of them the intercept, from (indices, values, label) in their order."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(i: np.ndarray) -> np.ndarray:
        return -np.sign(z[i]) * np.maximum(np.abs(z[i]) - L1, 0) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for i, x, label in examples:
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - sigma * w
            n[i] += g * g
    return weights(np.arange(size)).astype(np.float32)


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    examples = []
    for batch in batches:
        labels = batch.column("label").to_pylist()
        for first, end, data, ends in chunks(batch.column("text")):
            text, index = features(data, ends)
            at = np.searchsorted(text, np.arange(end - first + 1))
            for k in range(end - first):
                i, count = np.unique(index[at[k] : at[k + 1]], return_counts=True)
                x = count * (SCALE / max(1, count.sum()))
                examples.append((np.append(i, 1 << BITS), np.append(x, 1.0), labels[first + k]))
    w = train(examples)
    yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary())], ["weights"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> bytes:
    """Weights from labelled documents whose crc32(id as text) mod 3 is not 1, at most sample labels of them.

    Null ids and labels are not used. The sample has the smallest hashes of the id, and examples come in that order
    (then by id, label, text), so a rerun gives the same weights. Without any example, as in an empty table, every
    weight is 0. A null or empty text is an example of the intercept alone; a label whose id repeats counts each time,
    and so does a document. Texts are read whole; other columns are not read, whatever their names.
    """
    tune(docs.sparkSession)
    known = pick(labels, doc_id=id_col, label=label_col).where("doc_id is not null and label is not null and crc32(cast(doc_id as string)) % 3 <> 1")
    known = known.select("doc_id", F.col("label").cast("int").alias("label"), F.xxhash64("doc_id").alias("place"))
    known = known.orderBy("place", "doc_id", "label").limit(sample)
    rows = texts(docs, id_col, text_col).join(F.broadcast(known), "doc_id")
    rows = rows.repartition(1).sortWithinPartitions("place", "doc_id", "label", "text").select("text", "label")
    found = rows.mapInArrow(trimmed(_train), "weights binary").first()
    return bytes(found[0]) if found else train([]).tobytes()


def score(docs: DataFrame, weights: bytes, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Return per row of docs: doc_id, score (0 to 1), predicted (1 from 0.5 on), then the columns named by keep.

    One row in, one row out; null ids and repeated rows are kept; a null, empty or blank text is scored by the
    intercept alone; a text of any length is scored whole; an empty table gives an empty one. Other columns are not
    read, unless keep names them, whatever their names.
    """
    tune(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.frombuffer(shared.value, np.float32).astype(np.float64)
        for batch in batches:
            out = np.empty(len(batch))
            for first, end, data, ends in chunks(batch.column("text")):
                text, index = features(data, ends)
                sums = np.bincount(text, w[index].sum(axis=1), end - first)
                counts = np.maximum(1, np.bincount(text, minlength=end - first) * PER_TOKEN)
                out[first:end] = 1 / (1 + np.exp(-np.clip(w[-1] + SCALE * sums / counts, -35, 35)))
            columns = [batch.column("doc_id"), pa.array(out), pa.array((out >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns + batch.columns[2:], ["doc_id", "score", "predicted", *batch.schema.names[2:]])

    kept = {f"k{i}": name for i, name in enumerate(keep)}
    rows = pick(docs, doc_id=id_col, text=text_col, **kept).withColumn("text", F.coalesce("text", F.lit("")))
    kind = [f"{alias} {rows.schema[alias].dataType.simpleString()}" for alias in ("doc_id", *kept)]
    found = rows.mapInArrow(trimmed(scored), ", ".join([kind[0], "score double", "predicted int", *kind[1:]]))
    return found.toDF("doc_id", "score", "predicted", *keep)


def keep_good(docs: DataFrame, weights: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose text is predicted good, with all columns as they are, clashing names too.

    A null or empty text is kept or dropped by the intercept alone; rows with one text share a fate, whatever their
    ids; an empty table gives an empty one.
    """
    names = docs.columns
    plain = [f"c{i}" for i in range(len(names))]
    found = score(docs.toDF(*plain), weights, plain[names.index(id_col)], plain[names.index(text_col)], keep=tuple(plain))
    return found.where("predicted = 1").select(*plain).toDF(*names)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    held = F.coalesce(F.expr("crc32(cast(doc_id as string)) % 3 = 1"), F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")
