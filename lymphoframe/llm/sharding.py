"""Sharding: a keyed permutation of global row numbers deals rows to shards. SQL functions only.

Every row has a global number: its place in the order of the given columns, counted range by range (rows
are dealt to ranges, sorted there, and each range starts where the ones before it end), so it does not
depend on how many tasks did the work. A Feistel network permutes the numbers: number = right * A + left
with A = ceil(sqrt(rows)), and each round adds a keyed hash of one half to the other, modulo the
other's size. The network permutes a few numbers more than there are rows; a result past the last row
is put in again until it falls on one (cycle walking). Position p lies in shard p mod shards at slot
p div shards, so shards differ by one row at most, slots have no gaps, and ``shard``, ``slot`` and row
number are computed from each other (``position`` and ``row_number``) without any table.

Defined results: the law is ``rows``: shards are equal in rows, whatever the texts say; equal texts get
places of their own. A null doc_id comes before all others; rows that share doc_id and text are
interchangeable and get neighbouring numbers; rows that share only the doc_id are told apart by their
text's digest; a null text has size 1 and the CRC of nothing; an empty table has no shards; columns
of other names pass through ``deal``, those named like its own are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lymphoframe.llm.common import cut, let, partitions, table

SHARDS = 16
SEED = 20_261_128
ROUNDS = 6
#: Steps that a walk may take. A number is out of range with probability under 1/sqrt(rows), so of 4096
#: rows or fewer no cycle is longer, and of more a longer one has a chance under 2**-384; it is an error.
WALK = 64


def halves(total: int) -> tuple[int, int]:
    """The sizes of both halves: the smallest A with A*A >= total, and what it takes to hold total."""
    a = max(1, int(total**0.5))
    while a * a < total:
        a += 1
    while a > 1 and (a - 1) * (a - 1) >= total:
        a -= 1
    return a, max(1, -(-total // a))


def _shift(seed: int, k: int, half: Column, size: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed).cast("bigint"), F.lit(k).cast("bigint"), half.cast("bigint")), F.lit(size).cast("bigint"))


def _network(x: Column, total: int, seed: int, forward: bool) -> Column:
    a, b = halves(total)
    left, right = F.pmod(x, F.lit(a).cast("bigint")), F.call_function("div", x, F.lit(a).cast("bigint"))
    for k in range(ROUNDS) if forward else reversed(range(ROUNDS)):
        sign = 1 if forward else -1
        if k % 2 == 0:
            left = F.pmod(left + sign * _shift(seed, k, right, a), F.lit(a).cast("bigint"))
        else:
            right = F.pmod(right + sign * _shift(seed, k, left, b), F.lit(b).cast("bigint"))
    return right * F.lit(a).cast("bigint") + left


def _walked(x: Column, total: int, seed: int, forward: bool) -> Column:
    step = lambda y: F.when(y < total, y).otherwise(_network(y, total, seed, forward))
    on = lambda y: F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), y, lambda acc, _: step(acc))
    lost = F.raise_error(F.lit("a cycle of the permutation is too long: choose another seed")).cast("bigint")
    return let(_network(x, total, seed, forward), lambda y: F.when(y < total, y).otherwise(let(on(y), lambda z: F.when(z < total, z).otherwise(lost))))


def position(number: Column, total: int, seed: int = SEED) -> Column:
    """The place of a row in the shuffled order."""
    return _walked(number.cast("bigint"), total, seed, True)


def row_number(shard: Column, slot: Column, total: int, shards: int = SHARDS, seed: int = SEED) -> Column:
    """The global number of the row at a slot of a shard."""
    return _walked(slot.cast("bigint") * shards + shard.cast("bigint"), total, seed, False)


def numbered(rows: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """``rows`` with ``row_number`` (0, 1, ... in the order of the columns, nulls first), and how many there are.

    Rows are dealt to ranges and sorted there; what equals in all columns is split by its place in the
    scan, so no value is too frequent for its range. Only the ranges' sizes reach the driver."""
    spark = rows.sparkSession
    keys = [F.col(c).asc_nulls_first() for c in order]
    ranged = rows.drop("row_number").withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(partitions(spark), *keys, "_tie").sortWithinPartitions(*keys, "_tie")
    placed = cut(ranged.drop("_tie").withColumn("_place", F.monotonically_increasing_id()), "sharding-ranges")
    split = placed.withColumn("_range", F.shiftright("_place", 33)).withColumn("_within", F.col("_place").bitwiseAND((1 << 33) - 1))
    starts, total = [], 0
    for r in sorted(split.groupBy("_range").count().collect()):
        starts.append((r["_range"], total))
        total += r["count"]
    begin = spark.createDataFrame(starts, "_range long, _begin long")
    return split.join(F.broadcast(begin), "_range").withColumn("row_number", F.col("_begin") + F.col("_within")).drop("_range", "_within", "_begin", "_place"), total


def deal(rows: DataFrame, *order: str, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` with ``row_number``, ``shard`` and ``slot``."""
    placed, total = numbered(rows.drop("shard", "slot"), *order)
    at = position(F.col("row_number"), max(total, 1), seed)
    return placed.withColumn("_at", at).withColumn("shard", F.pmod("_at", F.lit(shards)).cast("int")).withColumn("slot", F.call_function("div", F.col("_at"), F.lit(shards).cast("bigint"))).drop("_at")


def write_shards(dealt: DataFrame, path: str) -> None:
    """Parquet by shard, each file a run of slots in order; a shard may have any number of files."""
    dealt.repartitionByRange(partitions(dealt.sparkSession), "shard", "slot").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    digests = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64("text").alias("_digest"))
    out = deal(cut(digests, "sharding-digests"), "doc_id", "_digest", "size", "text_crc32")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
