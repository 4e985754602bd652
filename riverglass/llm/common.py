"""What the corpus operators share: safe column picks, scratch tables, skew-safe joins, prefix sums."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A key with more than 1/HOT_SHARE of all rows is hot, so there are at most HOT_SHARE hot keys.
HOT_SHARE = 1000

#: Rows and bytes of an Arrow batch handed to Python; small, as one text may be very long.
ARROW_ROWS, ARROW_BYTES = 500, 8 << 20


def tune(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the Arrow batches, so that a batch of long texts stays small in the Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def trimmed(batches: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function over batches, after which a worker gives memory it no longer needs back to the system.

    Workers outlive their tasks, and what their allocators hold counts against the executor.
    """

    def run(it: Iterator) -> Iterator:
        import ctypes
        import gc

        import pyarrow as pa

        try:
            yield from batches(it)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # not every C library has it
                ctypes.CDLL(None).malloc_trim(0)

    return run


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Select columns by exact name, as alias=name.

    Columns are found by place, so other columns whose names clash (in another case, or twice) are harmless;
    of two columns with one name the first counts.
    """
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"c{names.index(name)}").alias(alias) for alias, name in wanted.items()])


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of docs, a null text as the empty one."""
    return pick(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))


def ascii_lower(text: Column | str) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), value being evaluated once a row; within a lambda a plain expression is evaluated for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one set here in a local session without it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jvm_dir.isDefined():
            found = jvm_dir.get()
        elif not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        else:  # driver and executors are one process, as in tests
            found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
            spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when this process ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # noqa: BLE001 - the session has ended; the folder's owner cleans up
        pass


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends at replicated files, which outlive executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str, total: int) -> DataFrame:
    """Left-join rows to their group's row (one per key), safe when one group holds much of all rows.

    groups has the group's number of rows in the column named by size. A group of over total / HOT_SHARE rows is
    hot; there are fewer than HOT_SHARE of those, so they are broadcast and their rows stay where they are. The
    other groups are joined by a shuffle in which no key has more than that share.
    """
    limit = max(1, total // HOT_SHARE)
    extra = [c for c in groups.columns if c not in keys]
    named = groups.toDF(*[f"_g_{c}" for c in groups.columns])
    same = [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys]
    found = [F.col(f"_g_{c}").alias(c) for c in extra]
    hot, cold = named.where(F.col(f"_g_{size}") > limit), named.where(F.col(f"_g_{size}") <= limit)
    marked = rows.join(F.broadcast(hot), same, "left")
    done = marked.where(F.col(f"_g_{size}").isNotNull()).select(*rows.columns, *found)
    rest = marked.where(F.col(f"_g_{size}").isNull()).select(*rows.columns)
    return done.unionByName(rest.join(cold, same, "left").select(*rows.columns, *found))


def running_total(df: DataFrame, order: str, value: str, into: str, width: int = 4096) -> DataFrame:
    """Add the sum of value over all rows with a smaller order (a dense long from 0), in two levels.

    Blocks of width consecutive rows are summed first, so a window task sees width rows or one row per block.
    """
    from pyspark.sql import Window

    blocked = df.withColumn("_block", F.floor(F.col(order) / width))
    sums = blocked.groupBy("_block").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return blocked.join(sums, "_block").withColumn(into, F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_block", "_base")
