"""Operator 7, exact dedup: rows are grouped by length, then prefix hash, then full hash of the survivors.

Each step drops rows that no other row can equal. What survives a step is kept as a bitmap of key hashes, whose
size is fixed, so it can be broadcast and no text is ever shuffled; a false hit costs one hash, never a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, join_groups, materialize, texts

PREFIX = 64
#: Bits of a bitmap: 1 MiB, broadcast as at most 131,072 rows. More bits let fewer unique rows through.
BITMAP_BITS = 1 << 23


def _slot(key: Column) -> Column:
    return F.pmod(key, F.lit(BITMAP_BITS))


def bitmap(keys: DataFrame) -> DataFrame:
    """A bitmap (word, bits) of the hashes in keys (a long key column); its size doesn't grow with them."""
    slots = keys.select(_slot(F.col("key")).alias("slot"))
    return slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits"))


def repeated(rows: DataFrame, key: Column) -> DataFrame:
    """A bitmap of the hashes of keys that more than one row has; a null key doesn't count."""
    return bitmap(rows.select(key.alias("key")).where("key is not null").groupBy("key").count().where("count > 1"))


def marked(rows: DataFrame, key: Column, bits: DataFrame, into: str) -> DataFrame:
    """Add whether the bitmap has the key."""
    slotted = rows.withColumn("_slot", _slot(key)).withColumn("_word", F.shiftright("_slot", 6))
    hit = slotted.join(F.broadcast(bits), F.col("_word") == F.col("word"), "left")
    return hit.withColumn(into, F.coalesce(F.expr("getbit(bits, cast(_slot % 64 as int))"), F.lit(0)) == 1).drop("_slot", "_word", "word", "bits")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Return per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty, and empty texts are equal.
    The largest doc_id of a group stays (null ids are smaller than any). Rows that repeat id and text are in one
    group, and one of them stays. text_sha256 is null for rows that no other row can equal, unless digest asks for
    it. An empty table gives an empty one; other columns are not read. A group may hold any share of the rows.
    """
    rows = texts(docs, id_col, text_col).withColumn("length", F.octet_length("text").cast("long"))
    # 1: the length
    lengths = repeated(rows, F.col("length"))
    # 2: the prefix, of rows whose length repeats
    prefix = F.xxhash64("length", ascii_lower(F.substring("text", 1, PREFIX)))
    second = marked(rows, F.col("length"), lengths, "same_length")
    prefixes = repeated(second, F.when(F.col("same_length"), prefix))
    # 3: the full text, of rows whose length and prefix repeat
    third = marked(rows, prefix, prefixes, "same_prefix")
    full = F.sha2(ascii_lower("text"), 256)
    hashed = third.select("doc_id", "same_prefix", (full if digest else F.when(F.col("same_prefix"), full)).alias("text_sha256"))
    hashed = materialize(hashed, "exact-dedup")
    total = hashed.count()
    survivors = hashed.where("same_prefix")
    groups = survivors.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    copies = survivors.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("copies"))
    found = join_groups(copies, groups, ["text_sha256"], "group_size", total)
    found = found.withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
    found = found.select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256")
    alone = hashed.where("not same_prefix").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    return found.unionByName(alone)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decision on every document, with the hash of every text."""
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)


ORACLE_SQL = """
WITH hashed AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents
), groups AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY text_sha256
)
SELECT h.doc_id, g.keep_id, g.group_size, h.doc_id = g.keep_id AS kept, h.text_sha256
FROM hashed h JOIN groups g ON h.text_sha256 = g.text_sha256
"""
