"""Embedding near-dedup over a robust-pruned flat graph.

Equal vectors form one class; the work is on classes, those of each length by themselves. Centroids
are fitted on a bounded sample (``SAMPLE`` classes with the smallest hashes of their id); every class is
dealt to the shards of its ``overlap`` nearest centroids. Where the sample can't give as many centroids
as the classes need shards, a shard is a pair of near centroids, so the number of shards grows with
the square of the sample and their size doesn't. A shard above ``SHARD`` members is split into blocks,
and every pair of blocks is a shard of its own, so no task's share is unbounded and no member is left
out.

Each shard builds a graph: a node's nearest neighbours, robust-pruned (a neighbour is dropped when one
already chosen is closer to it by a factor ``ALPHA``). The adjacency lists of a node from all its
shards are united and go back to them, and with them come, as guests, the neighbours from other shards
that could be linked with something in range of the node: edges lead out of the shard into the united
graph. Each member is then a query: a greedy beam search from the shard's medoid, then the range
expands from everything found in range, and from the query's own node, over neighbours still in
range, guests and their edges too, until nothing new comes. Pairs are verified by their cosine in
double precision. Two members may meet in several shards; their pair counts in the first shard
they share. A member and a guest that share none count for the member in its nearest shard (and the
other way round in the guest's). So a task adds up its own links and sends a row per node, not per
pair.

The recall is audited at every size: the links of ``AUDIT`` queries (smallest hashes) are counted among
all vectors; below ``RECALL`` the overlap doubles and the search is run again. The last audit's figure
comes with the result (``audited_recall``; null where the queries have no links: nothing was measured).

Defined results: vectors that are null, zero, hold null or non-finite components link with nothing
and are their own component; vectors of different lengths are never linked; repeated rows are linked
vectors; ties don't matter; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lymphoframe.llm.common import cut, partitions, small_batches, smallest_hashes, table
from lymphoframe.llm.graph import components, local_roots, whole_groups

SAMPLE = 16_384
PER_SHARD = 500
MOST_SHARDS = 4_096
SHARD = 4_096
OVERLAP = 4
NEAREST = 32
DEGREE = 16
ALPHA = 1.2
BEAM = 10
SLACK = 0.08
AUDIT = 256
RECALL = 0.98


def _unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(len(column), -1)


def classes_of(vectors: DataFrame) -> DataFrame:
    """(embedding, id, n, body): one row per distinct usable vector. ``body``: its float32 bytes."""
    sound = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    grouped = vectors.where(sound).groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            flat, ends = column.flatten().to_numpy(zero_copy_only=False).astype("<f4"), np.append(0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([column, *batch.columns[1:], pa.array([flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())], names=["embedding", "id", "n", "body"])

    kind = vectors.schema["embedding"].dataType.simpleString()
    return cut(grouped.mapInArrow(packed, f"embedding {kind}, id long, n long, body binary"), "vector-classes")


def centroids(sample: np.ndarray, number: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means on a bounded sample."""
    x = _unit(sample)
    found = x[np.linspace(0, len(x) - 1, number).astype(int)]
    for _ in range(rounds):
        home = (x @ found.T).argmax(1)
        sums = np.zeros_like(found)
        np.add.at(sums, home, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        found = np.where(size > 0, sums / np.maximum(size, 1e-12), found)
    return found


def _nearest(sims: np.ndarray, overlap: int, paired: bool) -> np.ndarray:
    """The shards of each row: its nearest centroids, or pairs of them (nearest first by their places)."""
    if not paired:
        return np.argsort(-sims, axis=1, kind="stable")[:, :overlap].astype("<i4")
    number = sims.shape[1]
    most = next(m for m in range(2, number + 1) if m * (m - 1) // 2 >= overlap or m == number)
    near = np.argsort(-sims, axis=1, kind="stable")[:, :most]
    pairs = sorted(((i, j) for j in range(most) for i in range(j)), key=lambda p: (sum(p), p))[:overlap]
    one, two = near[:, [i for i, _ in pairs]], near[:, [j for _, j in pairs]]
    return (np.minimum(one, two) * number + np.maximum(one, two)).astype("<i4")


def _dealt(classes: DataFrame, middles: np.ndarray, overlap: int, paired: bool) -> DataFrame:
    """(shard, low, high, own, home, shards, id, n, body): every class in each shard, or pair of blocks, that it
    belongs to; ``home`` marks the nearest shard."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = _nearest(_unit(_matrix(batch.column(2))) @ middles.T, overlap, paired)
            take = pa.array(np.repeat(np.arange(len(near)), near.shape[1]))
            shards = pa.array([x.tobytes() for x in near], pa.binary())
            home = np.tile(np.arange(near.shape[1]) == 0, len(near))
            yield pa.RecordBatch.from_arrays([pa.array(near.ravel()), pa.array(home), shards.take(take), *[batch.column(i).take(take) for i in range(3)]], names=["shard", "home", "shards", "id", "n", "body"])

    rows = cut(classes.select("id", "n", "body").mapInArrow(work, "shard int, home boolean, shards binary, id long, n long, body binary"), "vector-dealt")
    sizes = cut(rows.groupBy("shard").count().where(F.col("count") > SHARD).select("shard", F.ceil(2 * F.col("count") / SHARD).cast("int").alias("number")), "vector-sizes")
    rows = rows.join(sizes, "shard", "left").withColumn("number", F.coalesce("number", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("number")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("number") - 1)))
    return rows.select("shard", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "home", "shards", "id", "n", "body")


def pruned(x: np.ndarray) -> list[np.ndarray]:
    """Robust-pruned neighbour lists of unit vectors: of the nearest, those no chosen one stands before."""
    n = len(x)
    out = []
    most = min(NEAREST, n - 1)
    for first in range(0, n, 512):
        sims = x[first : first + 512] @ x.T
        sims[np.arange(len(sims)), np.arange(first, first + len(sims))] = -2
        near = np.argpartition(-sims, most - 1, axis=1)[:, :most] if most else np.empty((len(sims), 0), int)
        for row, cand in zip(sims, near, strict=True):
            cand = cand[np.argsort(-row[cand], kind="stable")]
            far = 1 - row[cand]
            between = 1 - x[cand] @ x[cand].T
            alive, chosen = np.ones(len(cand), bool), []
            for k in range(len(cand)):
                if alive[k]:
                    chosen.append(k)
                    if len(chosen) == DEGREE:
                        break
                    alive &= ALPHA * between[k] > far
            out.append(cand[chosen])
    return out


def _build(dealt: DataFrame, least: float) -> DataFrame:
    """(id, near, close): each node's edges; ``close``: the neighbour could be linked with a query that has
    the node in range."""
    reach = float(np.cos(min(np.pi, np.arccos(least) + np.arccos(max(least - SLACK, -1.0)))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, starts in whole_groups(batches, ["shard", "low", "high"]):
            ids = group.column("id").to_numpy()
            for first, last in zip(starts[:-1], starts[1:], strict=True):
                if last - first > 1:
                    mine, x = ids[first:last], _unit(_matrix(group.column("body").slice(first, last - first)))
                    lists = pruned(x)
                    row, near = np.repeat(np.arange(len(x)), [len(p) for p in lists]), np.concatenate(lists)
                    close = np.einsum("ij,ij->i", x[row], x[near]) >= reach - 1e-9
                    yield pa.RecordBatch.from_pydict({"id": mine[row], "near": mine[near], "close": close})

    return dealt.mapInArrow(work, "id long, near long, close boolean").distinct()


def _guests(dealt: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows as those of ``dealt`` (``own`` -1): close neighbours of a shard's members from other shards."""
    own = dealt.where("low = high")
    asked = own.select("shard", "low", "high", "id").join(edges.where("close").select("id", "near"), "id").select("shard", "low", "high", F.col("near").alias("id")).distinct()
    away = asked.join(own.select("shard", "id"), ["shard", "id"], "left_anti")
    return away.join(own.where("home").select("id", "shards", "n", "body"), "id").select("shard", "low", "high", F.lit(-1).alias("own"), F.lit(False).alias("home"), "shards", "id", "n", "body")


def _search(x: np.ndarray, lists: np.ndarray, least: float, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (query, node) in range found by beam search from the medoid and range expansion; queries are the
    ``members`` (rows), nodes may be guests. ``lists``: padded with -1. The range expands over edges in both directions (a hub's list is cut at
    ``DEGREE``, but every node that points to it is reached from it)."""
    n = len(x)
    row, place = np.nonzero(lists >= 0)
    ends = np.concatenate([row, lists[row, place]]), np.concatenate([lists[row, place], row])
    order = np.argsort(ends[0], kind="stable")
    target, first = ends[1][order], np.searchsorted(ends[0][order], np.arange(n + 1))
    beam = min(BEAM, n)
    medoid = int(members[(x[members] @ x[members].mean(0)).argmax()])
    short = x.astype(np.float32)
    found, sims_found = np.full((n, beam), -1), np.full((n, beam), -3.0, np.float32)
    for begin in range(0, len(members), 256):  # queries walk together, a few hundred at a time
        rows = members[begin : begin + 256]
        nodes = np.full((len(rows), beam), -1)
        sims = np.full((len(rows), beam), -3.0, np.float32)
        nodes[:, 0], sims[:, 0] = medoid, short[rows] @ short[medoid]
        done = np.zeros(nodes.shape, bool)
        live = np.arange(len(rows))
        for _ in range(4 * beam):
            best = np.where(done[live] | (nodes[live] < 0), -4.0, sims[live]).argmax(1)
            open_ = ~done[live, best] & (nodes[live, best] >= 0)
            live, best = live[open_], best[open_]
            if not len(live):
                break
            done[live, best] = True
            near = lists[nodes[live, best]]
            s = np.matmul(short[np.maximum(near, 0)], short[rows[live]][:, :, None])[:, :, 0]
            s[(near[:, :, None] == nodes[live][:, None, :]).any(2) | (near < 0)] = -5.0
            all_nodes, all_sims = np.concatenate([nodes[live], near], 1), np.concatenate([sims[live], s], 1)
            all_done = np.concatenate([done[live], np.zeros(near.shape, bool)], 1)
            top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            nodes[live], sims[live], done[live] = (np.take_along_axis(v, top, 1) for v in (all_nodes, all_sims, all_done))
            nodes[live] = np.where(sims[live] < -2.5, -1, nodes[live])
        found[rows], sims_found[rows] = nodes, sims
    a, b = [], []
    for q in members.tolist():
        seen = np.zeros(n, bool)
        seen[q] = True
        wave = np.unique(np.append(found[q][(found[q] >= 0) & (sims_found[q] >= least - SLACK)], q))
        seen[wave] = True
        hits = [wave]
        while len(wave):
            near = np.concatenate([target[first[v] : first[v + 1]] for v in wave.tolist()])
            near = np.unique(near[~seen[near]])
            near = near[x[near] @ x[q] >= least - SLACK]
            seen[near] = True
            hits.append(near)
            wave = near
        hit = np.concatenate(hits)
        hit = hit[(hit != q) & (x[hit] @ x[q] >= least)]
        a.append(np.full(len(hit), q))
        b.append(hit)
    return np.concatenate(a), np.concatenate(b)


_NONE = np.iinfo(np.int32).max


def _first_shared(shards: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest shard that both rows of each pair belong to (``_NONE`` without one)."""
    out = np.empty(len(a), np.int64)
    for k in range(0, len(a), 65_536):
        x, y = shards[a[k : k + 65_536]], shards[b[k : k + 65_536]]
        out[k : k + 65_536] = np.where((x[:, :, None] == y[:, None, :]).any(2), x, _NONE).min(1)
    return out


def _linked(dealt: DataFrame, edges: DataFrame, least: float) -> DataFrame:
    """(id, others, root): per node and shard with links counted there, the vectors it is linked to
    and a node that it reaches by them (one for all that hang together)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, starts in whole_groups(batches, ["shard", "low", "high"]):
            for first, last in zip(starts[:-1], starts[1:], strict=True):
                part = group.slice(first, last - first)
                ids, own = part.column("id").to_numpy(), part.column("own").to_numpy()
                members = np.flatnonzero(own >= 0)
                if len(ids) < 2 or not len(members):
                    continue
                order = np.argsort(ids)
                near = part.column("near").combine_chunks()
                flat = near.flatten().to_numpy(zero_copy_only=False)
                sizes = near.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                # neighbours in this shard, as its rows
                at = order[np.minimum(np.searchsorted(ids, flat, sorter=order), len(ids) - 1)]
                here = ids[at] == flat
                row = np.repeat(np.arange(len(ids)), sizes)[here]
                at = at[here]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                lists = np.full((len(ids), int(place.max()) + 1 if len(place) else 1), -1)
                lists[row, place] = at
                q, node = _search(_unit(_matrix(part.column("body"))), lists, least, members)
                shards = np.frombuffer(b"".join(part.column("shards").to_pylist()), "<i4").reshape(len(ids), -1)
                low, high, n = part.column("low")[0].as_py(), part.column("high")[0].as_py(), part.column("n").to_numpy()
                # a guest that shares no shard with the query, in the query's nearest shard
                out = (own[node] < 0) & part.column("home").to_numpy(zero_copy_only=False)[q]
                c, d = q[out], node[out]
                apart = _first_shared(shards, c, d) == _NONE
                c, d = c[apart], d[apart]
                q, node = q[own[node] >= 0], node[own[node] >= 0]
                pairs = np.unique(np.minimum(q, node) * len(ids) + np.maximum(q, node))
                a, b = pairs // len(ids), pairs % len(ids)
                counts = _first_shared(shards, a, b) == part.column("shard")[0].as_py()
                if low != high:  # members of one block meet in their block's own shard
                    counts &= own[a] != own[b]
                a, b = a[counts], b[counts]
                if not len(a) and not len(c):
                    continue
                others = np.bincount(a, n[b], len(ids)) + np.bincount(b, n[a], len(ids)) + np.bincount(c, n[d], len(ids))
                root = local_roots(len(ids), np.append(a, c), np.append(b, d))
                some = np.unique(np.concatenate([a, b, c, d]))
                yield pa.RecordBatch.from_pydict({"id": ids[some], "others": others[some].astype(np.int64), "root": ids[root[some]]})

    spark = dealt.sparkSession
    order = ["shard", "low", "high"]
    adjacency = cut(edges.groupBy("id").agg(F.collect_set("near").alias("near")), "vector-lists")
    nodes = dealt.unionByName(cut(_guests(dealt, edges), "vector-guests"))
    rows = nodes.join(adjacency, "id", "left").select(*order, "own", "home", "shards", "id", "n", "body", "near")
    return rows.repartition(partitions(spark), *order).sortWithinPartitions(*order).mapInArrow(work, "id long, others long, root long")


def _sorted(dealt: DataFrame) -> DataFrame:
    order = ["shard", "low", "high"]
    return dealt.repartition(partitions(dealt.sparkSession), *order).sortWithinPartitions(*order)


def audit(classes: DataFrame, found: DataFrame, least: float, total: int, queries: int = AUDIT) -> float | None:
    """Share of the links of a bounded set of queries that were found; None where these have no links, so that
    nothing was measured.

    The links of the queries with the smallest hashes are counted by brute force among all classes;
    found ones are verified, so they are a part of these."""
    chosen = smallest_hashes(classes.select("id", "body"), "id", queries, total).collect()
    if not chosen:
        return None
    ids = np.array([r["id"] for r in chosen])
    unit = _unit(np.frombuffer(b"".join(r["body"] for r in chosen), "<f4").reshape(len(chosen), -1))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ids), np.int64)
        for batch in batches:
            near = unit @ _unit(_matrix(batch.column(2))).T >= least
            near &= ids[:, None] != batch.column(0).to_numpy()[None, :]
            total += near @ batch.column(1).to_numpy()
        yield pa.RecordBatch.from_pydict({"id": ids, "true": total})

    true = classes.select("id", "n", "body").mapInArrow(work, "id long, true long").groupBy("id").agg(F.sum("true").alias("true"))
    mine = found.groupBy("id").agg(F.sum("others").alias("found"))
    row = true.join(mine, "id", "left").agg(F.sum("true").alias("true"), F.sum("found").alias("found")).first()
    return (row["found"] or 0) / row["true"] if row["true"] else None


def links(classes: DataFrame, least: float) -> tuple[DataFrame, float | None]:
    """(id, others, root) of the classes with links (see ``_linked``), written, and the audited recall; ``classes`` have
    one length."""
    total = classes.count()
    sample = [r["body"] for r in smallest_hashes(classes.select("id", "body"), "id", SAMPLE, total).collect()]
    wanted, most = -(-total // PER_SHARD), max(1, min(MOST_SHARDS, len(sample) // 8))
    number, paired = min(wanted, most), wanted > most > 1
    middles = centroids(np.frombuffer(b"".join(sample), "<f4").reshape(len(sample), -1), number)
    small_batches(classes.sparkSession)
    every = number * (number - 1) // 2 if paired else number
    overlap = min(OVERLAP, every)
    while True:
        dealt = cut(_dealt(classes, middles, overlap, paired), "vector-shards")
        edges = cut(_build(_sorted(dealt), least), "vector-graph")
        found = cut(_linked(dealt, edges, least), "vector-links")
        recall = audit(classes, found, least, total)
        if recall is None or recall >= RECALL or overlap == every:
            return found, recall
        overlap = min(2 * overlap, every)


def near_duplicates(vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id, kept, audited_recall: a row per vector."""
    classes = classes_of(vectors.select("vec_id", "embedding"))
    # a graph for each length of which there are two classes or more
    widths = [r["w"] for r in classes.groupBy(F.length("body").alias("w")).count().where("count > 1").orderBy("w").collect()]
    found = classes.select("id", F.col("n").alias("others"), F.col("id").alias("root")).limit(0)
    audited = []
    for width in widths:
        some, recall = links(classes.where(F.length("body") == width), least)
        found = found.unionByName(some)
        audited += [] if recall is None else [recall]
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), "vector")
    partners = found.groupBy("id").agg(F.sum("others").alias("others"))
    known = cut(classes.join(partners, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
                .select("embedding", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("root", "id").alias("component_id")), "vector-known")
    out = vectors.select("vec_id", "embedding").join(known, "embedding", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
                      F.lit(min(audited, default=None)).cast("double").alias("audited_recall"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
