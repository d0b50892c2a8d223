"""Vector codes against plain k-means in integers."""

import hashlib
import math

import numpy as np
import pytest

from lymphoframe.llm import codes
from lymphoframe.llm.registry import QUERIES


def plain(rows, entries=256, parts=4, rounds=4):
    """rows: (vec_id, label, vector). Plain k-means: every part against every entry, every round."""
    kept = [r for r in rows if r[2] is not None and len(r[2]) and all(x is not None and math.isfinite(x) for x in r[2])]
    x = np.array([[math.floor(1024 * float(v)) for v in r[2]] for r in kept], np.int64)
    width = x.shape[1] // parts
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, tuple(x[i])))[:entries]
    books = [x[first, p * width : (p + 1) * width].copy() for p in range(parts)]
    for turn in range(rounds + 1):
        code, error = [], np.zeros(len(x), np.int64)
        for p in range(parts):
            part = x[:, p * width : (p + 1) * width]
            d = np.stack([((part - c) ** 2).sum(1) for c in books[p]], 1)
            code.append(d.argmin(1))
            error += d.min(1)
            if turn < rounds:
                for e in range(len(books[p])):
                    mine = part[code[p] == e]
                    if len(mine):
                        books[p][e] = [int(s) // len(mine) for s in mine.sum(0)]
    by_label = {}
    for r, e in zip(kept, error.tolist(), strict=True):
        by_label[r[1]] = by_label.get(r[1], 0) + e
    sha = hashlib.sha256(",".join(str(v) for b in books for c in b.tolist() for v in c).encode()).hexdigest()
    return sorted((str(r[0]), "".join(f"{c[i]:02x}" for c in code), int(error[i]), by_label[r[1]], sha) for i, r in enumerate(kept))


def got(spark, folder):
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in QUERIES["op12_vector_codes"](spark, folder).collect())


def test_query_equals_plain_kmeans(spark, sf):
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert got(spark, sf) == plain(rows)


@pytest.fixture
def put(spark, tmp_path):
    def write(rows, schema="vec_id long, embedding array<float>, label int, code int, error string"):
        spark.createDataFrame([(i, v, k, 9, "x") for i, k, v in rows], schema).repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
        return str(tmp_path)

    return write


def test_clusters_ties_and_odd_rows(spark, put):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(40, 8))
    rows = [(i, int(i % 3) if i % 11 else None, (middles[i % 40] + rng.normal(size=8) * (0.05 if i % 2 else 0.0)).astype(np.float32).tolist()) for i in range(900)]
    rows += [(5000, 1, rows[0][2])] * 300  # a group of repeated rows
    rows += [(1, 2, rows[1][2]), (None, 1, rows[7][2]), (7000, 1, None), (7001, 1, []), (7002, None, [1.0] * 7 + [None]), (7003, 1, [float("nan")] * 8), (7004, 1, [float("inf")] + [0.0] * 7), (7005, 2, [0.0] * 8), (7006, 2, [-0.0005] * 8)]
    assert got(spark, put(rows)) == plain(rows)
    # lengths that are rarer, or that the parts don't divide, are left out
    assert got(spark, put([*rows, (8000, 1, [1.0] * 7), (8001, 1, [1.0] * 12)])) == plain(rows)


def test_few_and_no_rows(spark, put):
    few = [(3, 1, [1.0, 2.0, 3.0, 4.0]), (1, None, [1.0, 2.0, 3.0, 5.0]), (1, None, [1.0, 2.0, 3.0, 5.0])]
    assert got(spark, put(few)) == plain(few)
    assert got(spark, put(few[:1])) == plain(few[:1])
    assert got(spark, put([])) == []
    assert got(spark, put([(1, 1, None), (2, 1, [float("nan")] * 4)])) == []


def test_large_components_stay_exact(spark, put):
    rng = np.random.default_rng(9)
    rows = [(i, 1, (rng.normal(size=4) * 30000).tolist()) for i in range(400)]
    assert got(spark, put(rows, "vec_id long, embedding array<double>, label int, code int, error string")) == plain(rows)


def test_bounds_spare_most_of_the_work_and_lists_adapt(spark, put):
    rng = np.random.default_rng(7)
    middles = rng.normal(size=(64, 8))
    order = np.concatenate([np.arange(64).repeat(4), rng.integers(0, 64, 3000)])
    rows = [(i, 1, (middles[m] + rng.normal(size=8) * 0.02).astype(np.float32).tolist()) for i, m in enumerate(order)]
    report = []
    vectors = spark.read.parquet(f"{put(rows)}/embeddings.parquet")
    coded, _ = codes.compress(vectors, report=report)
    assert coded.count() == len(rows)
    served = [sum(n for k, n in needs.items() if k <= lists[0]) for lists, all_needs in report[1:-1] for needs in all_needs[:1]]
    assert all(s > 0.9 * len(rows) for s in served)
    assert report[0][0][0] == codes.CLOSEST and report[-1][0][0] <= report[0][0][0]
