"""Operator 5, mixing sources to target weights by hash thresholds.

Each document has a fixed hash. Words are summed by source and hash bucket; the bucket in which a source's budget
ends, and no other, is split again, and once more, down to one hash value. A document below its source's threshold is
taken once more than the others, so nothing is sorted and a rerun takes the same documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_groups, materialize, pick
from .exact_dedup import bitmap, marked

WEIGHTS = (3, 1, 2)
#: All targets together, and a source's most, as multiples of the sizes.
SHARE, MOST = 1.5, 2
#: Bits of the hash, in LEVELS steps.
LEVELS, STEP = 3, 12

SIZE_PATTERN = r"[^\x20\x09-\x0D]+"


def _mark(doc_id: str) -> Column:
    """The first hexadecimal digits of the id's MD5, as a number."""
    digits = F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 1, LEVELS * STEP // 4)
    return F.conv(digits, 16, 10).cast("long")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, mark): size is the number of words in the text, mark a hash of the id."""
    rows = pick(docs, doc_id=id_col, source=source_col, text=text_col)
    size = F.coalesce(F.regexp_count("text", F.lit(SIZE_PATTERN)), F.lit(0)).cast("long")
    return rows.select("doc_id", "source", size.alias("size"), _mark("doc_id").alias("mark"))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Add target to (source, source_size, rows), one row per source.

    Weights repeat over the sources by code point, null last. With a level L, a source gets least(most * size,
    weight * L); L is where these sum to share * all sizes. By rising cap per weight, the capped sources come first.
    One task sees the sources, one row each.
    """
    listed = sources.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    listed = listed.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")))
    listed = listed.withColumn("cap", F.col("source_size") * most)
    every, rising = Window.partitionBy(), Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    rest = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    listed = listed.withColumn("level", left / rest).withColumn("rank", F.row_number().over(rising))
    ends = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("rank", "level"))
    listed = listed.withColumn("level", F.min(ends).over(every)["level"])
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level"))
    return listed.select("source", "source_size", "rows", target.alias("target"))


def thresholds(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Add to plan: whole (times that every document is taken) and upto (the last mark that is taken once more)."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("whole", whole.cast("long")).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = materialize(plan, "mix-plan")
    ends = plan.where("budget > 0").select("source", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("taken"))
    for level in range(LEVELS):
        below = STEP * (LEVELS - 1 - level)
        slots = rows.select("source", "size", F.shiftright("mark", below + STEP).alias("prefix"), F.shiftright("mark", below).alias("slot"))
        if level:  # the rows of the boundary buckets; a false hit of the bitmap falls out in the join
            at = F.xxhash64("source", "prefix")
            slots = marked(slots, at, bitmap(ends.select(at.alias("key"))), "boundary").where("boundary").drop("boundary")
        sums = slots.groupBy("source", "prefix", "slot").agg(F.sum("size").alias("size"))
        last = ends.select(F.col("source").alias("end_source"), F.col("prefix").alias("end_prefix"), "budget", "taken")
        same = [F.col("source").eqNullSafe(F.col("end_source")), F.col("prefix") == F.col("end_prefix")]
        inside = sums.join(last, same).select("source", "budget", "taken", "slot", "size")
        upto = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
        reached = inside.withColumn("sum", F.col("taken") + F.sum("size").over(upto)).where("sum >= budget")
        first = reached.groupBy("source").agg(F.min(F.struct("slot", "budget", "sum", "size")).alias("f"))
        ends = first.select("source", F.col("f.budget").alias("budget"), F.col("f.slot").alias("prefix"), (F.col("f.sum") - F.col("f.size")).alias("taken"), F.col("f.sum").alias("reached"))
        ends = materialize(ends, "mix-ends")
    nearer = F.col("reached") - F.col("budget") < F.col("budget") - F.col("taken")
    ends = ends.select(F.col("source").alias("end_source"), F.when(nearer, F.col("prefix")).otherwise(F.col("prefix") - 1).alias("upto"))
    found = plan.join(ends, plan["source"].eqNullSafe(ends["end_source"]), "left")
    return found.select("source", "source_size", "rows", "target", "whole", F.coalesce("upto", F.lit(-1)).alias("upto"))


def _plan(rows: DataFrame) -> DataFrame:
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    return thresholds(rows, targets(sources))


def _times() -> Column:
    return F.col("whole") + F.when(F.col("mark") <= F.col("upto"), 1).otherwise(0)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Return per row of docs: doc_id, source, size, source_size, target, times, taken (= times * size).

    A null source is a source; a null or empty text has size 0 and takes nothing; a source of size 0 has target 0.
    Rows with one id share a hash, so repeated rows are taken alike; null ids count as one id. Where a source's budget
    ends at a hash, the documents with that hash are taken if that comes nearer. An empty table gives an empty one;
    other columns are not read. A source may hold any share of the rows.
    """
    rows = materialize(sized(docs, id_col, text_col, source_col), "mix-rows")
    found = join_groups(rows, _plan(rows), ["source"], "rows", rows.count()).withColumn("times", _times())
    return found.select("doc_id", "source", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of docs as often as the mix takes them, with all columns as they are, clashing names too.

    A row with a null, empty or blank text has size 0, and is repeated like others of its hash, which adds no words; a
    null source is a source; null ids share a hash, and so do rows with one id. An empty table gives an empty one.
    """
    names = docs.columns
    id_at, source_at = f"c{names.index(id_col)}", f"c{names.index(source_col)}"
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    rows = materialize(sized(docs, id_col, text_col, source_col), "mix-rows")
    plan = _plan(rows).withColumnRenamed("source", source_at)
    found = join_groups(plain.withColumn("mark", _mark(id_at)), plan, [source_at], "rows", rows.count())
    found = found.withColumn("_time", F.explode(F.sequence(F.lit(0).cast("long"), _times()))).where("_time > 0")
    return found.select(*plain.columns).toDF(*names)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 9))::BIGINT AS mark
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), listed AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sources
), weighed AS (
  SELECT *, 2 * source_size AS cap, CASE place % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM listed
), levels AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size)::BIGINT FROM sources) - coalesce(sum(cap) OVER w, 0)::BIGINT)
            / ((SELECT sum(weight)::BIGINT FROM weighed) - coalesce(sum(weight) OVER w, 0)::BIGINT) AS level,
         row_number() OVER (ORDER BY cap::DOUBLE / weight, place) AS rank
  FROM weighed WINDOW w AS (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
  SELECT level FROM levels WHERE level <= cap::DOUBLE / weight ORDER BY rank LIMIT 1
), planned AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * (SELECT level FROM chosen)) AS target FROM weighed
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM planned
), marks AS (
  SELECT source, mark, sum(size)::BIGINT AS size FROM sized GROUP BY source, mark
), sums AS (
  SELECT m.source, m.mark, m.size, b.target - b.whole * b.source_size AS budget,
         (sum(m.size) OVER (PARTITION BY m.source ORDER BY m.mark ROWS UNBOUNDED PRECEDING))::BIGINT AS reached
  FROM marks m JOIN budgets b ON m.source IS NOT DISTINCT FROM b.source
), ends AS (
  SELECT source, min(mark) AS mark FROM sums WHERE budget > 0 AND reached >= budget GROUP BY source
), upto AS (
  SELECT e.source, CASE WHEN s.reached - s.budget < s.budget - (s.reached - s.size) THEN s.mark ELSE s.mark - 1 END AS upto
  FROM ends e JOIN sums s ON e.source IS NOT DISTINCT FROM s.source AND e.mark = s.mark
)
SELECT z.doc_id, z.size, b.source_size, b.target, z.size * (b.whole + CASE WHEN z.mark <= coalesce(u.upto, -1) THEN 1 ELSE 0 END) AS taken
FROM sized z JOIN budgets b ON z.source IS NOT DISTINCT FROM b.source LEFT JOIN upto u ON z.source IS NOT DISTINCT FROM u.source
"""
