"""MinHash near-dedup by a multi-index Hamming join over b-bit signatures, links confirmed on full sets.

A document's set is its distinct five-word shingles. Documents with equal sets form one class; the
work below is on classes. A class has a signature of ``SYMBOLS`` min-hashes of 16 bits. The first
``CHUNKS * WIDTH`` of them are split into chunks; by the pigeonhole principle two signatures that
differ in fewer than ``2 * CHUNKS`` of these symbols have a chunk with at most one differing symbol,
so the index has a key for each chunk with each symbol left out in turn, and two such classes meet
under at least one key. Farther ones meet too unless each chunk has two differing symbols or more: of
pairs right at the similarity 2 in 10**8 miss at 0.85, 1 in 10**6 at 0.80. The limit on whole
signatures, seven deviations, adds 1 in 10**9.

1. Classes that meet are compared on whole signatures; what is close enough hangs together in rough
   groups. A key shared by more than ``HOT`` classes is split into blocks, and pairs of blocks meet.
2. The texts of classes in rough groups are read again and their full shingle sets are dealt to the
   groups, large groups again by pairs of blocks. Inside, pairs are taken by signature distance; one
   whose two classes already hang together by confirmed links is passed over (it can't change a
   component), any other is decided by the exact intersection and union.
3. Components of the confirmed links give each document its smallest reachable doc_id.

No step sends pairs anywhere: tasks emit spanning links only.

Defined results: null and empty texts, and texts without words, have an empty set and stand alone;
repeated rows and texts with equal sets are one class; a null doc_id takes part but is never a
component's id unless it stands alone, where the id is null too (and kept); columns but doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lymphoframe.llm.common import cut, partitions, small_batches, table
from lymphoframe.llm.graph import components, find, local_roots, pairs_within, whole_groups
from lymphoframe.llm.shingles import mix, shingle_sets

SHINGLE = 5
CHUNKS, WIDTH = 8, 4
SYMBOLS = 96
#: Signatures of sets at the similarity asked for differ in (1 - similarity) * SYMBOLS symbols on average; seven standard deviations more are let through.
DEVIATIONS = 7.0
HOT = 2048
BLOCK = 1024
SET_BLOCK = 64
MOST_BLOCKS = 32

_MULTIPLY = mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_ADD = mix(np.arange(1001, SYMBOLS + 1001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def signature(shingles: np.ndarray) -> np.ndarray:
    """``SYMBOLS`` 16-bit min-hashes of a non-empty set: the minima of multiply-add hashes, mixed before
    they are cut to 16 bits (a large set's minima all begin with zeros)."""
    least = None
    for k in range(0, len(shingles), 2048):
        part = (shingles[k : k + 2048, None] * _MULTIPLY + _ADD).min(0)
        least = part if least is None else np.minimum(least, part)
    return (mix(least) >> np.uint64(48)).astype("<u2")


def most_differing(similarity: float) -> int:
    p = 1 - similarity
    return int(SYMBOLS * p + DEVIATIONS * (SYMBOLS * p * (1 - p)) ** 0.5)


def _set_hash(shingles: np.ndarray) -> int:
    """64 bits of a whole set: the sum of its spread hashes, its size mixed in."""
    return int(mix(np.array([mix(shingles).sum() + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


def _keys(signs: np.ndarray) -> np.ndarray:
    """Index keys of many signatures: rows x (CHUNKS * WIDTH)."""
    parts = signs[:, : CHUNKS * WIDTH].reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
    out = np.empty((len(signs), CHUNKS, WIDTH), np.uint64)
    for left_out in range(WIDTH):
        key = np.broadcast_to((np.arange(CHUNKS) * WIDTH + left_out).astype(np.uint64), (len(signs), CHUNKS))
        for j in range(WIDTH):
            if j != left_out:
                key = mix(key * np.uint64(1 << 16) + parts[:, :, j])
        out[:, :, left_out] = key
    return out.reshape(len(signs), -1).view(np.int64)


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, copy (the text's hash), n_shingles, node (the set's hash), sign (binary); one row per document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(over="ignore"):
                sets = shingle_sets(batch.column(2).to_pylist(), SHINGLE)
                nodes = [_set_hash(s) if len(s) else None for s in sets]
                signs = [signature(s).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64()), pa.array(signs, pa.binary())], names=["doc_id", "copy", "n_shingles", "node", "sign"])

    small_batches(docs.sparkSession)
    return docs.select("doc_id", F.xxhash64("text").alias("copy"), "text").mapInArrow(work, "doc_id long, copy long, n_shingles long, node long, sign binary")


def _index(classes: DataFrame) -> DataFrame:
    """(key, node): every class under each of its index keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(-1, SYMBOLS)
            with np.errstate(over="ignore"):
                keys = _keys(signs)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), keys.shape[1]))], names=["key", "node"])

    return classes.select("node", "sign").mapInArrow(work, "key long, node long")


def _blocks(rows: DataFrame, block: Column, number: Column) -> DataFrame:
    """Deals each row to the pairs of blocks that its own belongs to: (low, high) for every other block."""
    own = rows.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), number - 1)))
    return own.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")).drop("other")


def _rough(classes: DataFrame, similarity: float) -> DataFrame:
    """(a, b): spanning pairs of classes that meet in the index and have close signatures."""
    most = most_differing(similarity)
    index = _index(classes)
    counts = cut(index.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "minhash-keys")
    met = cut(index.join(counts.hint("merge"), "key"), "minhash-index")
    number = F.when(F.col("n") <= HOT, 1).otherwise(F.ceil(F.col("n") / BLOCK)).cast("int")
    dealt = _blocks(met.join(classes.select("node", "sign"), "node"), F.pmod(F.xxhash64("node"), number).cast("int"), number)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, starts in whole_groups(batches, ["key", "low", "high"]):
            node = group.column("node").to_numpy()
            signs = np.frombuffer(b"".join(group.column("sign").to_pylist()), "<u2").reshape(-1, SYMBOLS)
            a, b = [], []
            for i, j in pairs_within(starts):
                near = (signs[i] != signs[j]).sum(1) <= most
                a.append(i[near])
                b.append(j[near])
            if a:
                root = local_roots(len(node), np.concatenate(a), np.concatenate(b))
                hung = root != np.arange(len(node))
                yield pa.RecordBatch.from_pydict({"a": node[hung], "b": node[root[hung]]})

    order = ["key", "low", "high"]
    sorted_rows = dealt.select(*order, "node", "sign").repartition(partitions(classes.sparkSession), *order).sortWithinPartitions(*order)
    return sorted_rows.mapInArrow(work, "a long, b long")


def _confirmed(docs: DataFrame, classes: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(a, b): spanning links between classes, decided on full sets inside the rough groups."""
    spark = docs.sparkSession
    most = most_differing(percent / 100)
    sizes = cut(groups.groupBy("root").agg(F.count("*").alias("n")), "minhash-sizes")
    members = groups.join(sizes, "root").join(classes.select("node", "doc_id"), "node")
    size = F.least(F.greatest(F.ceil(F.col("n") / MOST_BLOCKS), F.lit(SET_BLOCK)), F.lit(BLOCK))
    number = F.when(F.col("n") <= 2 * SET_BLOCK, 1).otherwise(F.ceil(F.col("n") / size)).cast("int")
    members = cut(members.select("node", F.col("doc_id").alias("rep"), "root", number.alias("number")), "minhash-members")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(over="ignore"):
                made = shingle_sets(batch.column(3).to_pylist(), SHINGLE)
                # a doc_id that several texts share: only the text that the class stands for
                right = [k for k, (s, node) in enumerate(zip(made, batch.column(0).to_pylist(), strict=True)) if len(s) and _set_hash(s) == node]
                signs = [signature(made[k]).tobytes() for k in right]
            rows = batch.take(pa.array(right, pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), rows.column(2), pa.array(signs, pa.binary()), pa.array([made[k].tobytes() for k in right], pa.binary())], names=["node", "root", "number", "sign", "shingles"])

    small_batches(spark)
    # members grow with the corpus: a merge join at every size, never a broadcast of them
    texts = docs.select(F.col("doc_id").alias("_id"), "text").join(members.hint("merge"), F.col("_id").eqNullSafe(F.col("rep"))).select("node", "root", "number", "text")
    full = texts.mapInArrow(sets, "node long, root long, number int, sign binary, shingles binary")
    dealt = _blocks(full, F.pmod(F.xxhash64("node"), F.col("number")).cast("int"), F.col("number"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, starts in whole_groups(batches, ["root", "low", "high"], 256):
            for first, last in zip(starts[:-1], starts[1:], strict=True):
                a, b = _links(group.slice(first, last - first), most, percent)
                if a:
                    yield pa.RecordBatch.from_pydict({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    order = ["root", "low", "high"]
    sorted_rows = dealt.select(*order, "own", "node", "sign", "shingles").repartition(partitions(spark), *order).sortWithinPartitions(*order)
    return sorted_rows.mapInArrow(work, "a long, b long")


def _links(group: pa.Table, most: int, percent: int) -> tuple[list[int], list[int]]:
    node, at = np.unique(group.column("node").to_numpy(), return_index=True)
    if len(node) < 2:
        return [], []
    bodies, own = group.column("shingles").to_pylist(), group.column("own").to_numpy()[at]
    signs = np.frombuffer(b"".join(group.column("sign").take(pa.array(at)).to_pylist()), "<u2").reshape(-1, SYMBOLS)
    sizes = np.array([len(bodies[k]) // 8 for k in at])
    cross = own.min() != own.max()
    found = []
    for i in range(len(node) - 1):
        j = np.arange(i + 1, len(node))
        if cross:
            j = j[own[j] != own[i]]
        # sets whose sizes are too unlike can't be linked
        j = j[100 * np.minimum(sizes[j], sizes[i]) >= percent * np.maximum(sizes[j], sizes[i])]
        far = (signs[j] != signs[i]).sum(1)
        j, far = j[far <= most], far[far <= most]
        found += zip(far.tolist(), [i] * len(j), j.tolist(), strict=True)
    parent, sets = list(range(len(node))), {}
    a, b = [], []
    for _, i, j in sorted(found):
        x, y = find(parent, i), find(parent, j)
        if x == y:
            continue
        for k in (i, j):
            if k not in sets:
                sets[k] = set(np.frombuffer(bodies[at[k]], np.uint64).tolist())
        common = len(sets[i] & sets[j])
        if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            parent[max(x, y)] = min(x, y)
            a.append(int(node[i]))
            b.append(int(node[j]))
    return a, b


def _linked(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, copy, n_shingles, node, root (the component's smallest node; null without words) and
    component_id, a row per document."""
    rows = cut(signed(docs), "minhash-signed")
    whole = rows.where("node is not null")
    classes = cut(whole.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("sign").alias("sign")), "minhash-classes")
    groups = cut(components(_rough(classes, percent / 100), "minhash-rough"), "minhash-groups")
    roots = cut(components(_confirmed(docs, classes, groups, percent), "minhash-links"), "minhash-roots")
    named = classes.select("node", "doc_id").join(roots, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    least = cut(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "minhash-least")
    ids = cut(named.join(least, "root", "left").select("node", "root", "component_id"), "minhash-ids")
    return rows.select("doc_id", "copy", "n_shingles", "node").join(ids, "node", "left").select("doc_id", "copy", "n_shingles", "node", "root", F.coalesce("component_id", "doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the smallest doc_id of its component), a row per document.

    Documents are linked where 100 * intersection >= ``percent`` * union of their shingle sets."""
    by_doc = _linked(docs, percent).select("doc_id", "n_shingles", "component_id")
    return by_doc.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id (null last), of its texts the one with
    the smallest hash, of its repeated rows any. Rows are told apart by doc_id and text, so what shares
    only the doc_id is judged on its own; rows without words all stay."""
    rows = cut(_linked(docs, percent).where("root is not null").select("doc_id", "copy", "root"), "minhash-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "copy"))
    winners = cut(rows.groupBy("root").agg(first.alias("w")).select("root", "w.doc_id", "w.copy"), "minhash-winners")
    wins = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("copy") == F.col("_copy"))
    met = rows.join(winners.select("root", F.col("doc_id").alias("_id"), F.col("copy").alias("_copy")).hint("merge"), "root")
    gone = cut(met.where(~wins).select("doc_id", "copy").distinct().select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy")), "minhash-gone")
    again = cut(met.where(wins).groupBy("doc_id", "copy").count().where("count > 1").select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy")), "minhash-again")
    left = docs.withColumn("copy", F.xxhash64("text")) if "copy" not in docs.columns else docs.withColumn("_own", F.col("copy")).withColumn("copy", F.xxhash64("text"))
    left = left.join(gone.hint("merge"), wins, "left_anti")
    out = left.join(again, wins, "left_anti").unionByName(left.join(again, wins, "left_semi").dropDuplicates(["doc_id", "copy"]))
    return out.drop("copy") if "_own" not in out.columns else out.drop("copy").withColumnRenamed("_own", "copy").select(docs.columns)


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), percent=85)
    return out.select("doc_id", "n_shingles", "component_id", "kept")
