"""Hard-negative mining over an inverted multi-index.

Vectors are cut into two halves, and each half has a codebook of its own (k-means over at most ``SAMPLE``
vectors, those with the smallest hashes of their id); every row lies in the cell of its two codes, so K codes a
half make K*K cells, as many as rows need. A query bounds a row's score (inner product) by its cell: in
each half, the product with the code plus the query's length times the code's radius, the largest
distance of any row with that code. The two lists of half bounds, sorted, are walked by the
multi-sequence algorithm: a heap gives the cells by falling sum of their bounds, and the walk ends
where a window is certified: the next bound lies below its k-th best score (or below the window), so
no row left could enter it. Cells whose rows all lie above every window are passed over.

The walk goes in waves. Each open query asks for its next cells, of ``FIRST_ROWS`` rows at first and
``GROWTH`` times as many in each later wave; queries meet rows cell by cell, in blocks of both (a cell
of very many rows, or one that very many queries ask for, is spread over tasks); a block sends on only
rows that can still enter a window, at most k for each; and the best are kept by a ranked window. What
the index saves depends on the data, what it returns doesn't: bounds are exact but for rounding,
which a margin covers, and scores are integers.

First each anchor's positives are found (its best rows of the same label), then the negatives of each
positive (the best rows of other labels within shares of its score), all windows of an anchor in one walk.

Defined results: rows with a null label, a null or empty vector, or a null or not finite component take no part;
nor do rows with a component beyond ``limit`` after scaling (scores would not fit a long), and rows
whose length isn't the most frequent one (ties: the smaller). Repeated rows are rows of their own, told
apart after vec_id by their place in the index; a null vec_id is never an anchor and comes last among
equal scores; fewer rows than asked for are all returned; a positive with a score below 0 has no
negatives; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lymphoframe.llm.codes import _binary as binary_rows
from lymphoframe.llm.codes import _plain as plain_rows
from lymphoframe.llm.common import cut, drop, floors, partitions, scratch, smallest_hashes, sound, table
from lymphoframe.llm.graph import whole_groups

SCALE = 256
SAMPLE = 16_384
#: Rows of a cell on average, and codes of a half at most.
PER_CELL, MOST_CODES = 256, 1024
FIRST_ROWS, GROWTH = 2_048, 8
#: Rows and queries of a cell that meet in one go.
ROWS_BLOCK, QUERIES_BLOCK = 2_048, 4_096
FAR = 1 << 62
_LAST = np.iinfo(np.int64).max


def limit(width: int) -> int:
    """The largest component: a hundred times a score fits a long."""
    return int((2**55 / max(1, width)) ** 0.5)


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of integer rows, exact. By float products where these are exact."""
    bound = int(np.abs(queries).max(initial=0)) * int(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    kind = np.float64 if bound < 2**53 else np.int64
    return (queries.astype(kind) @ rows.astype(kind).T).astype(np.int64)


def codebook(sample: np.ndarray, number: int, rounds: int = 8) -> np.ndarray:
    """k-means of a bounded sample, from evenly spread rows of it."""
    found = sample[np.linspace(0, len(sample) - 1, number).astype(int)].astype(np.float64)
    for _ in range(rounds):
        home = _closest(sample, found)
        count = np.bincount(home, minlength=number)[:, None]
        sums = np.zeros_like(found)
        np.add.at(sums, home, sample)
        found = np.where(count > 0, sums / np.maximum(count, 1), found)
    return found


def _closest(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return ((codes * codes).sum(1)[None, :] - 2 * (x @ codes.T)).argmin(1)


def multi_sequence(one: np.ndarray, two: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, i, j) of all cells by falling one[i] + two[j]; the heap holds a cell for each row begun."""
    a, b = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
    first, second = one[a].tolist(), two[b].tolist()
    heap = [(-(first[0] + second[0]), 0, 0)]
    while heap:
        total, x, y = heapq.heappop(heap)
        yield -total, int(a[x]), int(b[y])
        if y == 0 and x + 1 < len(first):
            heapq.heappush(heap, (-(first[x + 1] + second[0]), x + 1, 0))
        if y + 1 < len(second):
            heapq.heappush(heap, (-(first[x] + second[y + 1]), x, y + 1))


class Index:
    """Rows (id, vec_id, label, body, cell), written, with what bounds their scores: codes, radii, and the cells' sizes
    (at most ``MOST_CODES`` squared numbers)."""

    def __init__(self, rows: DataFrame, width: int, total: int) -> None:
        """``rows``: vec_id, label, body (little-endian 32-bit integers)."""
        self.width, self.half = width, width // 2
        sample = smallest_hashes(rows.select("vec_id", "body"), "vec_id", SAMPLE, total, "body").collect()
        x = np.frombuffer(b"".join(r["body"] for r in sample), "<i4").reshape(len(sample), width).astype(np.float64)
        number = max(1, min(MOST_CODES, int((total / PER_CELL) ** 0.5), len(x) // 8))
        self.books = [codebook(x[:, : self.half], number), codebook(x[:, self.half :], number)]
        self.rows = cut(self._dealt(rows), "negatives-index")
        self.radii = []
        for side in ("one", "two"):
            radius = np.zeros(number)
            for r in self.rows.groupBy(side).agg(F.max(f"r_{side}").alias("r")).collect():
                radius[r[side]] = r["r"]
            self.radii.append(radius * (1 + 1e-12))
        self.sizes = np.zeros(number * number, np.int64)
        for r in self.rows.groupBy("cell").count().collect():
            self.sizes[r["cell"]] = r["count"]

    def _dealt(self, rows: DataFrame) -> DataFrame:
        width, half, books = self.width, self.half, self.books

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = plain_rows(batch.column(3), "<i4", width).astype(np.float64)
                parts, codes, radii = (x[:, :half], x[:, half:]), [], []
                for part, book in zip(parts, books, strict=True):
                    codes.append(_closest(part, book).astype("i4"))
                    radii.append(np.sqrt(((part - book[codes[-1]]) ** 2).sum(1)))
                cell = codes[0] * len(books[1]) + codes[1]
                yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(v) for v in (*codes, cell.astype("i4"), *radii)]], names=["id", "vec_id", "label", "body", "one", "two", "cell", "r_one", "r_two"])

        numbered = rows.select(F.monotonically_increasing_id().alias("id"), "vec_id", "label", "body")
        return numbered.mapInArrow(work, "id long, vec_id long, label long, body binary, one int, two int, cell int, r_one double, r_two double")

    def ask(self, queries: DataFrame, quota: int) -> DataFrame:
        """The next cells of each query (id, label, body, done, lows, highs), until they hold ``quota`` rows: a row of
        the query with ``cell`` and the ``blocks`` of it, and one with cell -1 where it asked for any. ``done``: cells
        walked so far."""
        width, half, books, radii, sizes = self.width, self.half, self.books, self.radii, self.sizes

        def walk(q: np.ndarray, done: int, least: int, most: int) -> tuple[list[int], int]:
            sides = []
            for part, book, radius in ((q[:half], books[0], radii[0]), (q[half:], books[1], radii[1])):
                middle, reach = book @ part, np.linalg.norm(part) * radius
                sides.append((middle + reach, middle - reach, float(np.abs(middle).max(initial=0) + reach.max(initial=0))))
            margin = 1e-9 * (sides[0][2] + sides[1][2]) + 1e-6
            cells, taken, walked = [], 0, 0
            for upper, i, j in multi_sequence(sides[0][0], sides[1][0]):
                walked += 1
                if walked <= done:
                    continue
                if upper + margin < least:
                    break
                cell = i * len(books[1]) + j
                if sizes[cell] and sides[0][1][i] + sides[1][1][j] - margin <= most:
                    cells.append(cell)
                    taken += int(sizes[cell])
                    if taken >= quota:
                        break
            return cells, walked

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for first in range(0, whole.num_rows, 64):
                    batch = whole.slice(first, 64)
                    x = plain_rows(batch.column(2), "<i4", width).astype(np.float64)
                    take, cells, ends = [], [], batch.column(3).to_numpy(zero_copy_only=False).copy()
                    for k, (lows, highs) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                        mine, ends[k] = walk(x[k], int(ends[k]), min(lows), max(highs)) if lows else ([], 0)
                        if mine:
                            take += [k] * (len(mine) + 1)
                            cells += [-1, *mine]
                    at, cell = pa.array(take, pa.int64()), np.array(cells, "i4")
                    blocks = np.where(cell < 0, 0, -(-sizes[cell] // ROWS_BLOCK)).astype("i4")
                    columns = [c.take(at) for c in batch.columns]
                    columns[3] = pa.array(ends[take].astype("i8") if take else [], pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(blocks), *columns], names=["cell", "blocks", "id", "label", "body", "done", "lows", "highs"])

        return queries.select("id", "label", "body", "done", "lows", "highs").mapInArrow(work, "cell int, blocks int, id long, label long, body binary, done long, lows array<long>, highs array<long>")

    def meet(self, asked: DataFrame, same: bool, k: int) -> DataFrame:
        """(id, window, score, vec_id, row): rows of the asked cells within the queries' windows, at most ``k`` best
        for each window and block; of the query's label, or of any other."""
        width = self.width
        wanted = asked.where("cell >= 0")
        shape = cut(wanted.groupBy("cell").agg(F.max("blocks").alias("blocks"), F.ceil(F.count("*") / QUERIES_BLOCK).cast("int").alias("groups")), "negatives-cells")
        upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        dealt = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
        order = ["cell", "block", "group"]
        rows = self.rows.select("cell", "id", "vec_id", "label", "body").join(F.broadcast(shape), "cell").withColumn("block", dealt("blocks")).withColumn("group", upto("groups"))
        rows = rows.select(*order, F.lit(0).alias("side"), "id", "vec_id", "label", "body", F.lit(None).cast("array<long>").alias("lows"), F.lit(None).cast("array<long>").alias("highs"))
        queries = wanted.drop("blocks").join(F.broadcast(shape), "cell").withColumn("group", dealt("groups")).withColumn("block", upto("blocks"))
        queries = queries.select(*order, F.lit(1).alias("side"), "id", F.lit(None).cast("bigint").alias("vec_id"), "label", "body", "lows", "highs")

        def best(scores: np.ndarray, fits: np.ndarray, low: int, high: int, ids: np.ndarray, vec_ids: np.ndarray) -> np.ndarray:
            found = np.flatnonzero(fits & (scores >= low) & (scores <= high))
            if len(found) > k:
                found = found[scores[found] >= np.partition(scores[found], len(found) - k)[len(found) - k]]
            return found[np.lexsort((ids[found], vec_ids[found], -scores[found]))][:k]

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for group, starts in whole_groups(batches, order):
                sides, labels, ids = group.column("side").to_numpy(), group.column("label").to_numpy(), group.column("id").to_numpy()
                names = group.column("vec_id").fill_null(_LAST).to_numpy()
                bodies = plain_rows(group.column("body").combine_chunks(), "<i4", width)
                lows, highs = group.column("lows"), group.column("highs")
                out: list[list[np.ndarray]] = [[], [], [], [], []]
                for first, last in zip(starts[:-1], starts[1:], strict=True):
                    middle = first + int((sides[first:last] == 0).sum())  # rows come before queries
                    row_ids, row_names, row_labels = ids[first:middle], names[first:middle], labels[first:middle]
                    for begin in range(middle, last, 256):
                        end = min(begin + 256, last)
                        scores = products(bodies[begin:end], bodies[first:middle])
                        for q in range(begin, end):
                            s = scores[q - begin]
                            fits = ((row_labels == labels[q]) == same) & (row_ids != ids[q])
                            for w, (low, high) in enumerate(zip(lows[q].as_py(), highs[q].as_py(), strict=True)):
                                hit = best(s, fits, low, high, row_ids, row_names)
                                for column, values in zip(out, (np.full(len(hit), ids[q]), np.full(len(hit), w, "i4"), s[hit], row_names[hit], row_ids[hit]), strict=True):
                                    column.append(values)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["id", "window", "score", "vec_id", "row"])

        both = rows.unionByName(queries).repartition(partitions(self.rows.sparkSession), *order).sortWithinPartitions(*order, "side")
        return both.mapInArrow(work, "id long, window int, score long, vec_id long, row long")

    def search(self, queries: DataFrame, same: bool, k: int, report: list | None = None) -> DataFrame:
        """(id, window, rank, score, vec_id, row): the ``k`` first rows of each window of the queries (id, label, body, lows,
        highs), by score, then vec_id, then place; written."""
        ranked = Window.partitionBy("id", "window").orderBy(F.desc("score"), "vec_id", "row")
        found, quota = None, FIRST_ROWS
        now = queries.withColumn("done", F.lit(0).cast("bigint"))
        while True:
            asked = cut(self.ask(now, quota), "negatives-asked")
            if asked.isEmpty():
                break
            fresh = self.meet(asked, same, k)
            if found is not None:
                fresh = fresh.unionByName(found.drop("rank"))
            best = cut(fresh.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k), "negatives-best")
            if report is not None:
                report.append(asked.where("cell >= 0").groupBy("cell").count().withColumn("size", F.element_at(F.lit(self.sizes.tolist()), F.col("cell") + 1)).agg(F.sum(F.col("count") * F.col("size"))).first()[0])
            full = best.where(F.col("rank") == k).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("kth"))
            raised = F.transform("lows", lambda low, w: F.greatest(low, F.coalesce(F.try_element_at("kth", w), low)))
            before = (found, asked)
            now = cut(asked.where("cell < 0").join(full, "id", "left").select("id", "label", "body", "done", F.when(F.col("kth").isNull(), F.col("lows")).otherwise(raised).alias("lows"), "highs"), "negatives-open")
            found = best
            for old in before:
                if old is not None:
                    drop(old)
            quota *= GROWTH
        return found if found is not None else queries.sparkSession.createDataFrame([], "id long, window int, score long, vec_id long, row long, rank int")


def usable(vectors: DataFrame) -> tuple[DataFrame, int, int] | None:
    """(vec_id, label, body) of the rows that take part, written, their length and number; None where there are none."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), "embedding").where(F.col("label").isNotNull() & sound("embedding", SCALE, limit(1)))
    common = rows.groupBy(F.size("embedding").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if common is None:
        return None
    width = common["w"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(batch.num_rows, width)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), binary_rows(flat)], names=["vec_id", "label", "body"])

    fitting = rows.where((F.size("embedding") == width) & sound("embedding", SCALE, limit(width))).select("vec_id", "label", floors("embedding", SCALE).alias("ints"))
    out = cut(fitting.mapInArrow(packed, "vec_id long, label long, body binary"), "negatives-rows")
    total = out.count()
    return (out, width, total) if total else None


def mine(vectors: DataFrame, anchors, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, report: list | None = None) -> DataFrame | None:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), lazily over written tables; ``anchors``: a
    condition on vec_id. Negatives have ``least`` to ``most`` percent of their positive's score."""
    found = usable(vectors)
    if found is None:
        return None
    index = Index(*found)
    asking = cut(index.rows.where(anchors).select("id", "vec_id", "label", "body"), "negatives-anchors")
    window = lambda low, high: (F.array(low).alias("lows"), F.array(high).alias("highs"))
    firsts = index.search(asking.select("id", "label", "body", *window(F.lit(-FAR), F.lit(FAR))), True, positives, report)
    # a window for each positive, in their order
    entry = F.struct("rank", F.col("score"), "vec_id", F.call_function("div", least * F.col("score") + 99, F.lit(100).cast("bigint")).alias("low"), F.call_function("div", most * F.col("score"), F.lit(100).cast("bigint")).alias("high"))
    of = cut(firsts.where("score >= 0").groupBy("id").agg(F.array_sort(F.collect_list(entry)).alias("of")), "negatives-positives")
    probes = asking.join(of, "id")
    seconds = index.search(probes.select("id", "label", "body", F.col("of.low").alias("lows"), F.col("of.high").alias("highs")), False, negatives, report)
    told = probes.select("id", F.col("vec_id").alias("anchor_id"), F.posexplode("of").alias("window", "p"))
    named = lambda c: F.when(F.col(c) != int(_LAST), F.col(c))
    return seconds.join(told, ["id", "window"]).select("anchor_id", F.when(F.col("p.vec_id") != int(_LAST), F.col("p.vec_id")).alias("positive_id"), F.col("rank").cast("int").alias("rank"), named("vec_id").alias("negative_id"),
                                                       F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of ids divisible by 7 are changed first, so that some rows are labelled wrong; ids divisible by 100 are anchors."""
    vectors = table(spark, sf_dir, "embeddings")
    wrong = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label").cast("bigint")))
    with scratch(spark):
        found = mine(wrong, F.col("vec_id") % 100 == 0)
        if found is not None:
            return cut(found, "negatives", keep=True)
    return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
