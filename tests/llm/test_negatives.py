"""Hard negatives against scores of all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lymphoframe.llm import negatives
from lymphoframe.llm.registry import QUERIES

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def plain(rows):
    """rows: (vec_id, label, vector): every anchor against every row."""
    kept = [(i, k if i is None or i % 7 else (k + 1) % 10, v) for i, k, v in rows if k is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(256 * float(c)) for c in v] for _, _, v in kept], np.int64)
    out = []
    for a, (i, label, _) in enumerate(kept):
        if i is None or i % 100:
            continue
        scores = (x @ x[a]).tolist()
        order = sorted((r for r in range(len(kept)) if r != a), key=lambda r: (-scores[r], kept[r][0] is None, kept[r][0]))
        for p in [r for r in order if kept[r][1] == label][:5]:
            fits = [r for r in order if kept[r][1] != label and 30 * scores[p] <= 100 * scores[r] <= 90 * scores[p]]
            out += [(i, kept[p][0], n, kept[r][0], scores[p], scores[r]) for n, r in enumerate(fits[:10], 1)]
    return sorted(out, key=repr)


def got(spark, folder):
    return sorted((tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_hard_negatives"](spark, folder).collect()), key=repr)


def test_query_equals_all_pairs(spark, sf):
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert got(spark, sf) == plain(rows)


@pytest.fixture
def put(spark, tmp_path):
    def write(rows):
        spark.createDataFrame([(i, v, k, 9, "x") for i, k, v in rows], "vec_id long, embedding array<double>, label int, score int, cell string").repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
        return str(tmp_path)

    return write


def clustered(number, seed=3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(25, 6))
    return [(i, int(rng.integers(0, 4)), (middles[i % 25] + rng.normal(size=6) * 0.3).round(2).tolist()) for i in range(number)]


def test_waves_blocks_ties_and_odd_rows(spark, put, monkeypatch):
    for name, value in (("FIRST_ROWS", 8), ("GROWTH", 3), ("ROWS_BLOCK", 16), ("QUERIES_BLOCK", 4), ("PER_CELL", 8)):
        monkeypatch.setattr(negatives, name, value)
    rows = clustered(700)
    rows += [(900 + i, 1, rows[0][2]) for i in range(60)]  # a group of copies, an anchor among them
    rows += [(None, 2, rows[5][2]), (1001, None, rows[5][2]), (1002, 1, None), (1003, 1, []), (1004, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1005, 1, [float("nan")] * 6), (1100, 2, [float("inf")] + [0.0] * 5), (1200, 2, [0.0] * 6), (1300, 3, [-9.0, -9.0, 0.0, 0.0, 0.0, 0.0]), (1400, 8, [1.0] * 6)]
    assert got(spark, put(rows)) == plain(rows)


def test_bounds_end_the_walk_early(spark, put, monkeypatch):
    monkeypatch.setattr(negatives, "PER_CELL", 8)
    monkeypatch.setattr(negatives, "FIRST_ROWS", 64)
    rng = np.random.default_rng(11)
    middles = rng.normal(size=(100, 8))
    middles /= np.linalg.norm(middles, axis=1, keepdims=True)
    rows = [(i, int(i % 2), (middles[i % 100] + rng.normal(size=8) * 0.02).tolist()) for i in range(3000)]
    vectors = spark.read.parquet(f"{put(rows)}/embeddings.parquet")
    index = negatives.Index(*negatives.usable(vectors))
    asking = index.rows.where("vec_id % 100 = 0").select("id", "label", "body", F.array(F.lit(-negatives.FAR)).alias("lows"), F.array(F.lit(negatives.FAR)).alias("highs"))
    report = []
    assert index.search(asking, True, 5, report).count() == 150
    assert sum(report) < 0.2 * 30 * 3000


def test_multi_sequence_falls_and_is_complete():
    rng = np.random.default_rng(1)
    one, two = rng.normal(size=7), rng.normal(size=5)
    cells = list(negatives.multi_sequence(one, two))
    assert sorted((i, j) for _, i, j in cells) == [(i, j) for i in range(7) for j in range(5)]
    assert all(x[0] >= y[0] for x, y in zip(cells, cells[1:]))


def test_large_scores_and_small_tables(spark, put):
    rng = np.random.default_rng(2)
    big = [(i * 50, int(i % 3), (rng.normal(size=4) * 30000).tolist()) for i in range(60)]
    assert got(spark, put(big)) == plain(big)
    assert got(spark, put([(100, 1, [1.0, 2.0])])) == []
    two = [(100, 1, [1.0, 2.0]), (101, 1, [1.0, 2.0]), (102, 2, [0.5, 1.0])]
    assert got(spark, put(two)) == plain(two) != []
    assert got(spark, put([])) == [] and got(spark, put([(100, None, [1.0]), (200, 1, None)])) == []
