"""Connected components and grouped streaming, shared by the near-duplicate operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lymphoframe.llm.common import cut


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root): every node with an edge and the smallest node it reaches.

    Alternating large and small stars: each round, neighbours are hung on the smallest one seen, until
    nothing changes. ``edges`` has long columns a, b. The minima are written before they are joined
    back, so a node with very many neighbours is a skewed join key that Spark can split."""
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{label}-edges")
    state = _state(now)
    while state[0]:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), f"{label}-large")
        large = cut(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), f"{label}-stars")
        least = cut(large.groupBy("a").agg(F.min("b").alias("m")), f"{label}-small")
        hung = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut(hung.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), f"{label}-edges")
        state, before = _state(now), state
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("h")).first()
    return row["n"], row["h"]


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], at_least: int = 2048) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Of batches sorted by ``keys`` (in one partition): tables of whole groups, and where each group
    starts (the table's length comes last). Only the open group and one batch are held."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < at_least:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        starts = _starts(table, keys)
        last = int(starts[-2])
        if last:
            yield table.slice(0, last).combine_chunks(), starts[:-1]
        held = table.slice(last).combine_chunks().to_batches()
        rows = table.num_rows - last
        at_least = max(at_least, 2 * rows)
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, _starts(table, keys)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for k in keys:
        x = table.column(k).to_numpy()
        change[1:] |= x[1:] != x[:-1]
    return np.append(np.flatnonzero(change), table.num_rows)


def pairs_within(starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of one group, as arrays, by growing distance."""
    sizes = np.diff(starts)
    end = np.repeat(starts[1:], sizes)
    rows = np.arange(starts[-1])
    step = 1
    while True:
        rows = rows[rows + step < end[rows]]
        if not len(rows):
            return
        yield rows, rows + step
        step += 1


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row each row reaches over the pairs (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x
