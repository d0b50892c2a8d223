"""Vector code compression: a codebook for each part of the vectors, by exact k-means with adaptive bounds.

Vectors are cut into equal parts; each part is coded as the nearest entry of its position's codebook.
The k-means that fits the codebooks works on every vector, in integers. What makes its rounds cheap
are bounds (after Drake and Hamerly): for each part of each vector the ``b`` closest other entries are
kept in order, with a lower bound on the distance to each, and one outer bound for all the rest. When
entries move, bounds shrink by what they moved. An entry whose bound lies beyond the distance to the
assigned one can't win; so a prefix of the list is left to look at, most often none, and only where the
outer bound is reached all entries are measured again. Bounds are floats rounded down; whatever they
leave open, ties too, is decided by squared distances in integers. After each round ``b`` shrinks to
what nearly all vectors needed.

The bounds live in a table in the shared folder, written anew by each round (the one before is
deleted), so a lost executor costs the tasks it ran. A round sends the changes of the entries' sums to
the driver: a row per part and entry. Codebooks are parts * entries * width numbers, whatever the
table's size, and so are small enough for every task.

Defined results: a vector that is null, empty, or holds a null or a component that isn't finite is left
out; so is one with a component beyond ``limit`` after scaling (its errors would not fit a long), and
one whose length isn't the most frequent length that the parts divide (ties: the smaller). Repeated
rows count and are coded each by itself; a null vec_id comes after all others in the choice of the
first entries, rows that share a vec_id come in the order of their components; fewer vectors than
entries make fewer entries; null labels are one label; an empty table gives an empty one; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lymphoframe.llm.common import cut, drop, floors, smallest, sound, table

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Entries in the lists at first, and at least.
CLOSEST, FEWEST = 16, 2
#: Share of the vectors that may need more than the list; then all entries are measured.
OVERFLOW = 0.01
#: Vectors that a task works on at once.
CHUNK = 4096
_SAFE = 1e-12


def limit(width: int) -> int:
    """The largest component: squared distances of whole vectors fit a long."""
    return int((2**60 / width) ** 0.5)


def exact(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of integer rows to integer entries, exact. By float products where these are exact."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = np.float64 if 4 * most * most * max(1, x.shape[1]) < 2**53 else np.int64
    a, c = x.astype(kind), entries.astype(kind)
    return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def _ordered(lower: np.ndarray) -> np.ndarray:
    """Bounds that grow along each row: none above a later one (the outer bound comes last)."""
    return np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1]


def measured(x: np.ndarray, entries: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(assigned, near, lower) of rows against all entries: the nearest (ties: the first), the b closest
    others in order, and lower bounds on the distances to these and, last, to the rest."""
    d = exact(x, entries)
    assigned = d.argmin(1)
    others = d.astype(np.float64)
    others[np.arange(len(x)), assigned] = np.inf
    if b + 1 < d.shape[1]:
        near = np.argpartition(others, b, axis=1)[:, : b + 1]
        near = np.take_along_axis(near, np.argsort(np.take_along_axis(others, near, 1), axis=1, kind="stable"), 1)
        lower = np.sqrt(np.take_along_axis(others, near, 1))
        return assigned, near[:, :b].astype(np.uint8), _down(lower)
    near = np.argsort(others, axis=1, kind="stable")[:, :b]
    lower = np.concatenate([np.sqrt(np.take_along_axis(others, near, 1)), np.full((len(x), 1), np.inf)], 1)
    return assigned, near.astype(np.uint8), _down(lower)


def moved(x: np.ndarray, entries: np.ndarray, drift: np.ndarray, assigned: np.ndarray, near: np.ndarray, lower: np.ndarray):
    """(assigned, near, lower, need) after the entries moved by ``drift``. ``need``: how many of the list had to
    be looked at; one more than its length where all entries were."""
    b = near.shape[1]
    shrink = np.concatenate([drift[near], np.full((len(x), 1), drift.max(initial=0.0))], 1)
    lower = _ordered(_down(lower.astype(np.float64) - shrink))
    away = x - entries[assigned]
    own = (away * away).sum(1)
    need = (np.sqrt(own.astype(np.float64))[:, None] * (1 + _SAFE) >= lower.astype(np.float64)).sum(1)
    assigned, near = assigned.copy(), near.copy()
    some = np.flatnonzero((need > 0) & (need <= b))
    if len(some):
        open_ = np.arange(b) < need[some, None]
        apart = x[some, None, :] - entries[near[some]]
        far = np.iinfo(np.int64).max
        d = np.concatenate([own[some, None], np.where(open_, (apart * apart).sum(2), far)], 1)
        ids = np.concatenate([assigned[some, None], near[some].astype(np.int64)], 1)
        order = np.lexsort((ids, d), axis=1)
        d, ids = np.take_along_axis(d, order, 1), np.take_along_axis(ids, order, 1)
        assigned[some] = ids[:, 0]
        near[some] = np.where(open_, ids[:, 1:], near[some])
        inner = np.where(open_, _down(np.sqrt(np.where(open_, d[:, 1:], 0).astype(np.float64))), lower[some, :b])
        lower[some] = _ordered(np.concatenate([inner, lower[some, b:]], 1))
    full = np.flatnonzero(need > b)
    if len(full):
        assigned[full], near[full], lower[full] = measured(x[full], entries, b)
    return assigned, near, lower, need


def _plain(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """A column of binaries of one length as a matrix."""
    n = len(column)
    if not n or not width:
        return np.zeros((n, width), kind)
    ends = np.frombuffer(column.buffers()[1], "<i4")[column.offset : column.offset + n + 1]
    return np.frombuffer(column.buffers()[2], "u1")[ends[0] : ends[-1]].view(kind).reshape(n, width)


def _binary(x: np.ndarray) -> pa.Array:
    x = np.ascontiguousarray(x)
    ends = np.arange(len(x) + 1, dtype="<i4") * (x.shape[1] * x.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(x.tobytes())])


def _spread(sizes: list[int]) -> list[slice]:
    ends = np.cumsum([0, *sizes])
    return [slice(int(a), int(b)) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _schema(rows: DataFrame) -> str:
    return f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, label {rows.schema['label'].dataType.simpleString()}, body binary, code binary, was binary, near binary, lower binary, need binary, error long"


_NAMES = ["vec_id", "label", "body", "code", "was", "near", "lower", "need", "error"]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, CHUNK):
            yield batch.slice(first, CHUNK)


def first_round(rows: DataFrame, books: np.ndarray, lists: list[int]) -> DataFrame:
    """The table of codes and bounds from rows (vec_id, label, ints), all entries measured."""
    parts, _, width = books.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            body = flat.astype("<i4").reshape(batch.num_rows, parts * width)
            found = [measured(body[:, p * width : (p + 1) * width].astype(np.int64), books[p], lists[p]) for p in range(parts)]
            yield _record(batch, body, books, [f[0] for f in found], None, [f[1] for f in found], [f[2] for f in found], [np.full(len(body), 255)] * parts)

    return rows.mapInArrow(work, _schema(rows))


def next_round(state: DataFrame, books: np.ndarray, drift: np.ndarray, held: list[int], lists: list[int]) -> DataFrame:
    """The table after the entries moved: ``held`` entries in each part's list so far, ``lists`` from now on."""
    parts, _, width = books.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            body = _plain(batch.column(2), "<i4", parts * width)
            code = _plain(batch.column(3), "u1", parts)
            near, lower = _plain(batch.column(4), "u1", sum(held)), _plain(batch.column(5), "<f4", sum(held) + parts)
            out = []
            for p, (n, w) in enumerate(zip(_spread(held), _spread([h + 1 for h in held]), strict=True)):
                bounds = lower[:, w]
                bounds = np.concatenate([bounds[:, : lists[p]], bounds[:, lists[p] :].min(1, keepdims=True)], 1)
                out.append(moved(body[:, p * width : (p + 1) * width].astype(np.int64), books[p], drift[p], code[:, p].astype(np.int64), near[:, n][:, : lists[p]], bounds))
            yield _record(batch, body, books, [o[0] for o in out], code, [o[1] for o in out], [o[2] for o in out], [o[3] for o in out])

    return state.select("vec_id", "label", "body", "code", "near", "lower").mapInArrow(work, _schema(state))


def _record(batch: pa.RecordBatch, body: np.ndarray, books: np.ndarray, codes: list, was: np.ndarray | None, near: list, lower: list, need: list) -> pa.RecordBatch:
    parts, _, width = books.shape
    nearest = np.concatenate([books[p][codes[p]] for p in range(parts)], 1)
    away = body.astype(np.int64) - nearest
    code = np.stack(codes, 1).astype("u1")
    columns = [batch.column(0), batch.column(1), _binary(body), _binary(code), _binary(code[:, :0] if was is None else was), _binary(np.concatenate(near, 1).astype("u1")),
               _binary(np.concatenate(lower, 1).astype("<f4")), _binary(np.stack(need, 1).astype("u1")), pa.array((away * away).sum(1))]
    return pa.RecordBatch.from_arrays(columns, names=_NAMES)


def changes(state: DataFrame, parts: int, width: int) -> DataFrame:
    """(part, entry, n, s0, s1, ...): what the round changed in the number and sums of each entry's parts; rows with
    entry -1 - k count the parts that needed k entries of their list."""
    names = ["part", "entry", "n", *[f"s{j}" for j in range(width)]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums, needs = np.zeros((parts, 256), np.int64), np.zeros((parts, 256, width), object), np.zeros((parts, 256), np.int64)
        for batch in _chunks(batches):
            body, code, need = _plain(batch.column(0), "<i4", parts * width), _plain(batch.column(1), "u1", parts), _plain(batch.column(3), "u1", parts)
            fresh = batch.column(2).slice(0, 1)[0].as_py() == b""
            was = None if fresh else _plain(batch.column(2), "u1", parts)
            for p in range(parts):
                needs[p] += np.bincount(need[:, p], minlength=256)
                other = np.ones(len(body), bool) if fresh else code[:, p] != was[:, p]
                x = body[other, p * width : (p + 1) * width].astype(np.int64)
                for sign, home in ((1, code[other, p]), *(() if fresh else ((-1, was[other, p]),))):
                    count[p] += sign * np.bincount(home, minlength=256)
                    here = np.zeros((256, width), np.int64)  # at most CHUNK numbers of 31 bits a cell
                    np.add.at(here, home, x)
                    sums[p] += sign * here
        some = [(p, e) for p in range(parts) for e in range(256) if count[p, e] or any(sums[p, e])]
        used = [(p, k) for p in range(parts) for k in np.flatnonzero(needs[p]).tolist()]
        columns = [pa.array([p for p, _ in some + used], pa.int32()), pa.array([e for _, e in some] + [-1 - k for _, k in used], pa.int32()), pa.array([int(count[p, e]) for p, e in some] + [int(needs[p, k]) for p, k in used], pa.int64())]
        columns += [pa.array([int(sums[p, e, j]) for p, e in some] + [0] * len(used), pa.int64()) for j in range(width)]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = state.select("body", "code", "was", "need").mapInArrow(work, "part int, entry int, " + ", ".join(f"{c} long" for c in names[2:]))
    return rows.groupBy("part", "entry").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in names[2:]])


def _fewer(needs: dict[int, int], b: int) -> int:
    """The list length that all but ``OVERFLOW`` of the parts that a list served would have managed with."""
    served = {k: n for k, n in needs.items() if k <= b}
    left = int(OVERFLOW * sum(served.values()))
    for k in range(b, FEWEST, -1):
        left -= served.get(k, 0)
        if left < 0:
            return k
    return min(b, FEWEST)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, closest: int = CLOSEST, report: list | None = None) -> tuple[DataFrame, np.ndarray] | None:
    """The coded vectors (vec_id, label, code: one byte a part, error), written, and the codebooks (parts,
    entries, width); None without a usable vector. ``report`` gets each round's list lengths and needs."""
    if not 1 <= entries <= 256:
        raise ValueError("an index is one byte: 1 to 256 entries")
    usable = vectors.select("vec_id", "label", "embedding").where(F.pmod(F.size("embedding"), F.lit(parts)) == 0)
    common = usable.where(sound("embedding", scale, limit(parts))).groupBy(F.size("embedding").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if common is None:
        return None
    width = common["w"] // parts
    rows = usable.where((F.size("embedding") == common["w"]) & sound("embedding", scale, limit(common["w"]))).select("vec_id", "label", floors("embedding", scale).alias("ints"))
    first = smallest(rows.select("vec_id", "ints"), entries, "vec_id", "ints").collect()
    if not first:
        return None
    books = np.array([r["ints"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    count = np.zeros((parts, len(first)), object)
    sums = np.zeros((parts, len(first), width), object)
    lists = [min(closest, len(first) - 1, 253)] * parts
    state = cut(first_round(rows, books, lists), "codes-round")
    for _ in range(rounds):
        needs: list[dict[int, int]] = [{} for _ in range(parts)]
        for row in changes(state, parts, width).collect():
            if row["entry"] < 0:
                needs[row["part"]][-1 - row["entry"]] = int(row["n"])
            else:
                count[row["part"], row["entry"]] += int(row["n"])
                sums[row["part"], row["entry"]] += np.array([int(row[f"s{j}"]) for j in range(width)], object)
        if report is not None:
            report.append((lists, needs))
        new = books.copy()
        for p, e in np.argwhere(count > 0).tolist():
            new[p, e] = [int(s) // int(count[p, e]) for s in sums[p, e]]
        step = (new - books).astype(np.float64)
        drift = np.sqrt((step * step).sum(2)) * (1 + _SAFE)
        held, lists = lists, [_fewer(n, b) if any(k <= b for k in n) else b for n, b in zip(needs, lists, strict=True)]
        books, before = new, state
        state = cut(next_round(before, books, drift, held, lists), "codes-round")
        drop(before)
    if report is not None:
        report.append((lists, None))
    return state.select("vec_id", "label", "code", "error"), books


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = compress(vectors)
    if found is None:
        return vectors.limit(0).selectExpr("vec_id", "'' AS code", "0L AS error", "0L AS label_error", "'' AS codebooks_sha256")
    coded, books = found
    labels = cut(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels")
    both = coded.join(labels.withColumnRenamed("label", "_label"), F.col("label").eqNullSafe(F.col("_label")))
    return both.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
