"""Sharding against a plain version of the same network, and its laws."""

import struct
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from lymphoframe.llm import sharding
from lymphoframe.llm.registry import QUERIES

ODD = [(3, "b"), (None, "no id"), (3, "a"), (1, None), (1, ""), (2, "é𝄞" * 900), (2, "é𝄞" * 900), (2, "é𝄞" * 900), (None, None)]


def hashed(*values):
    """Spark's xxhash64 of longs: each value hashed with the hash before it as the seed."""
    h = 42
    for v in values:
        h = xxhash.xxh64(struct.pack("<q", v), seed=h).intdigest()
    return h - (1 << 64) if h >> 63 else h


def placed(x, total, seed):
    a, b = sharding.halves(total)
    while True:
        right, left = divmod(x, a)
        for k in range(sharding.ROUNDS):
            if k % 2 == 0:
                left = (left + hashed(seed, k, right) % a) % a
            else:
                right = (right + hashed(seed, k, left) % b) % b
        x = right * a + left
        if x < total:
            return x


@pytest.mark.parametrize("total", [1, 2, 3, 5, 17, 100, 1000, 4097])
def test_permutation_and_its_inverse(spark, total):
    at = spark.range(total).withColumn("p", sharding.position(F.col("id"), total, 7))
    at = at.withColumn("back", sharding.row_number(F.col("p") % 16, F.expr("p div 16"), total, 16, 7)).collect()
    assert sorted(r["p"] for r in at) == list(range(total))
    assert all(r["back"] == r["id"] for r in at)
    assert all(r["p"] == placed(r["id"], total, 7) for r in at[:200])


def test_halves_hold_all_rows():
    for total in [*range(1, 300), 10**6, 10**12 + 1, 2**53 + 1]:
        a, b = sharding.halves(total)
        assert a * b >= total > a * (b - 1) and a * b - total < a


def brute(rows, seed=sharding.SEED):
    total = len(rows)
    out = {}
    for n, (i, size, crc) in enumerate(rows):
        p = placed(n, total, seed)
        out[n] = (i, size, crc, p % 16, p // 16)
    return out


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op13_sharding"](spark, sf).collect()
    rows = [(d.doc_id, len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in sorted(docs, key=lambda d: d.doc_id)]
    assert sorted((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got) == sorted(brute(rows).values())
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def lawful(rows, shards):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(k, [])) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_odd_rows_do_not_depend_on_the_layout(spark, tmp_path):
    found = []
    for parts in (1, 3, 9):
        docs = spark.createDataFrame([(i, t, "x", 5) for i, t in (ODD if parts != 3 else ODD[::-1])], "doc_id long, text string, shard string, row_number int").repartition(parts)
        docs.write.mode("overwrite").parquet(f"{tmp_path}/{parts}/documents.parquet")
        got = QUERIES["op13_sharding"](spark, f"{tmp_path}/{parts}").collect()
        lawful(got, 16)
        found.append(sorted(((r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32, r.shard, r.slot) for r in got)))
        rows = sharding.deal(docs, "doc_id", "text", shards=4).collect()
        lawful(rows, 4)
        assert sorted(r.row_number for r in rows) == list(range(len(ODD)))
    assert found[0] == found[1] == found[2] and len(found[0]) == len(ODD)


def test_hot_value_and_empty_table(spark, tmp_path):
    hot = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text"))
    rows = sharding.deal(hot, "doc_id", "text", shards=7)
    lawful(rows.collect(), 7)
    sharding.write_shards(rows, f"{tmp_path}/shards")
    assert spark.read.parquet(f"{tmp_path}/shards").where("shard = 3").count() in (714, 715)
    assert sharding.deal(hot.where("false"), "doc_id", "text").collect() == []
