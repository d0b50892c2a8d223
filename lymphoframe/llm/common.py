"""Shared helpers of the training-data operators: session settings, durable tables, word rules."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed value: words are maximal runs of anything but these white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``); a local one only where it is unset."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


#: Folders written by ``cut`` inside ``scratch``.
_made: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """The tables that ``cut`` writes inside (but those it is told to keep) are deleted at the end, when
    what was made of them has been written."""
    _made.append([])
    try:
        yield
    finally:
        for path in _made.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop(written: DataFrame) -> None:
    """Deletes a table that ``cut`` wrote and that nothing reads any more."""
    _delete(written.sparkSession, written._folder)


def cut(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later stages neither recompute it nor
    depend on the executors that made it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # shuffle files go with the query that made them
    before = spark.conf.get(cleanup, "false")
    spark.conf.set(cleanup, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    if _made and not keep:
        _made[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once (a lambda argument is bound, not inlined)."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Rows in an Arrow batch: a few thousand average documents fit a Python worker, long ones too.
BATCH_ROWS = 256


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def smallest_hashes(df: DataFrame, key: str, number: int, total: int, *ties: str) -> DataFrame:
    """``number`` of ``total`` rows, those with the smallest hashes of ``key``. Rows that can't be among
    them are left out before the sort, so that tasks together send about twice ``number`` rows to the
    driver and not ``number`` each (where a key repeats very often the sample may be smaller)."""
    span = 1 << 30
    place = F.pmod(F.xxhash64(F.coalesce(key, F.lit(0))), F.lit(span))
    bound = span if total <= 2 * number else -(-2 * number * span // total)
    return df.where(place < bound).orderBy(place, key, *ties).limit(number)


#: Groups of tasks that ``smallest`` takes its first choice from.
CHOICES = 64


def smallest(df: DataFrame, number: int, *keys: str) -> DataFrame:
    """The ``number`` first rows by ``keys``: the first of each group of tasks (found before the shuffle),
    and of those the first. What meets in one task is bounded, whatever the number of tasks."""
    order = [F.col(k).asc_nulls_last() for k in keys]
    rank = F.row_number().over(Window.partitionBy("_group").orderBy(*order))
    chosen = df.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(CHOICES))).withColumn("_rank", rank).where(F.col("_rank") <= number)
    return chosen.drop("_group", "_rank").orderBy(*order).limit(number)


def sound(column: str, scale: int, most: int) -> Column:
    """True for an array that has components, none of them null or not finite, none beyond ``most`` after
    multiplication by ``scale``."""
    fits = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double") * scale) <= most)
    return F.coalesce((F.size(column) > 0) & F.forall(column, fits), F.lit(False))


def floors(column: str, scale: int) -> Column:
    """array<int>: floor(scale * x) of each component, as double."""
    return F.transform(column, lambda x: F.floor(x.cast("double") * scale).cast("int"))
