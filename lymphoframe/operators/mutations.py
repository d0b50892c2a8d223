"""Mutation counts and frequencies by position, region, region class and in all.

A sequence is one row with packed vectors, bytes that numpy reads a batch at a time: ``r`` and ``s`` (mutations by
position, 32-bit numbers) and ``mutable`` (the position has an aligned codon that is no gap). Sums by key
add the vectors element by element, first in the tasks that read the rows, batch by batch; a task leaves a
row for every key and ``CHUNK`` positions, and Spark adds these. ``summed_rows`` makes and adds the vectors of a
batch at once, so that none leaves the task. The long form (a row per position) appears
only after it, once per key. Regions, classes and the whole are rolled up from there by grouping sets;
``wide_counts`` pivots with an explicit list. Tables that come in the long form are summed as they are
(``weighted``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lymphoframe.functions import aligned
from lymphoframe.functions.calls import at_level, weight
from lymphoframe.operators.groups import by_repertoire, mean_std
from lymphoframe.schema import POSITIONS, REGIONS

SUMS = ("r", "s", "r_aa", "s_aa", "total", "total_aa")
#: Positions whose sums are added by one row; divides the number of positions.
CHUNK = 8
#: Keys whose sums a task keeps (4 KB each) before it passes them on.
KEPT = 4096

Work = Callable[[pa.RecordBatch], list[pa.Array]]
#: r, s (rows by positions) of a batch, told what is mutable.
Counts = Callable[[pa.RecordBatch, np.ndarray], tuple[np.ndarray, np.ndarray]]
Vectors = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _batchwise(rows: DataFrame, keep: tuple[str, ...], made: list[tuple[str, T.DataType]], work: Work) -> DataFrame:
    """The columns ``keep`` of the rows and those that ``work`` makes of each batch."""
    kept = rows.select(*keep).schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *work(batch)], [*keep, *[n for n, _ in made]])

    return rows.mapInArrow(run, T.StructType([*kept, *[T.StructField(n, t) for n, t in made]]))


def _region_columns(batch: pa.RecordBatch) -> list[pa.Array]:
    return [batch.column(r) for r in REGIONS]


def _by_region(rows: DataFrame, read: Work | None, made: list[tuple[str, T.DataType]], work: Callable[[list[pa.Array]], list[pa.Array]]) -> DataFrame:
    if read is None:
        rows, read = rows.select("sequence_id", *REGIONS), _region_columns
    return _batchwise(rows, ("sequence_id",), made, lambda batch: work(read(batch)))


def region_lengths(rows: DataFrame, read: Work | None = None) -> DataFrame:
    """Per sequence and region: letters that are no gap, and codons that are not all gaps. ``read`` makes a batch's
    aligned regions, in order, where they are no columns of the rows."""
    return _by_region(rows, read, _LENGTHS, _region_lengths)


def region_translations(rows: DataFrame, read: Work | None = None) -> DataFrame:
    return _by_region(rows, read, _LETTERS, _region_letters)


_LENGTHS = [(f"mu_total_count_{r}{x}", T.IntegerType()) for r in REGIONS for x in ("", "_aa")]
_LETTERS = [(f"{r}_aa", T.StringType()) for r in REGIONS]


def _region_lengths(regions: list[pa.Array]) -> list[pa.Array]:
    return [x for r in regions for x in aligned.lengths(r)]


def _region_letters(regions: list[pa.Array]) -> list[pa.Array]:
    return [aligned.translated(r) for r in regions]


def _place(pos: str) -> tuple[str, str]:
    """SQL of the region and the class of a position."""
    cases = " ".join(f"WHEN {pos} <= {last} THEN '{region}'" for region, (_, last) in REGIONS.items())
    region = f"CASE {cases} END"
    return region, f"substr({region}, 1, 3)"


def from_wide(rows: DataFrame, *carried: str) -> DataFrame:
    """The long form of rows with mu_count_{position}_{r,s} columns: position, r, s."""
    count = lambda k: F.array(*[F.coalesce(F.col(f"mu_count_{p}_{k}").cast("int"), F.lit(0)) for p in range(1, POSITIONS + 1)]).alias(k)
    return rows.select("sequence_id", *carried, F.posexplode(F.arrays_zip(count("r"), count("s"))).alias("i", "x")).select("sequence_id", *carried, (F.col("i") + 1).alias("pos"), "x.r", "x.s")


_VECTORS = [("r", T.BinaryType()), ("s", T.BinaryType()), ("mutable", T.BinaryType())]


def _vectors(counts: Counts, regions: list[pa.Array], batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mutable = aligned.mutable(regions)
    return *counts(batch, mutable), mutable


def packed_rows(rows: DataFrame, counts: Counts, *carried: str, read: Work = _region_columns) -> DataFrame:
    """sequence_id, carried and packed vectors of rows with aligned regions. ``counts`` says a batch's mutations
    (r, s: rows by positions) from its columns and what is mutable, ``read`` its regions, in order."""
    told = [(i, r) for i, r in enumerate(REGIONS) if r in carried]

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        regions = read(batch)
        r, s, mutable = _vectors(counts, regions, batch)
        return [*[regions[i].cast(pa.string()) for i, _ in told], aligned.packed(r.astype("<i4")), aligned.packed(s.astype("<i4")), aligned.packed(mutable.view("u1"))]

    return _batchwise(rows, ("sequence_id", *[c for c in carried if c not in REGIONS]), [*[(r, T.StringType()) for _, r in told], *_VECTORS], work)


def from_rows(rows: DataFrame, *carried: str) -> DataFrame:
    """sequence_id, carried, r, s, mutable: packed vectors of rows with mu_count_{position}_{r,s} and aligned regions."""
    count = lambda k: F.array(*[F.coalesce(F.col(f"mu_count_{p}_{k}").cast("int"), F.lit(0)) for p in range(1, POSITIONS + 1)]).alias(f"_{k}")
    others = [c for c in carried if c not in REGIONS]
    return packed_rows(rows.select("sequence_id", *others, *REGIONS, count("r"), count("s")), lambda batch, _: (aligned.numbers(batch.column("_r")), aligned.numbers(batch.column("_s"))), *carried)


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return aligned.unpacked(batch.column("r"), "<i4"), aligned.unpacked(batch.column("s"), "<i4"), aligned.unpacked(batch.column("mutable"), "?")


def spelled_out(vectors: DataFrame, *carried: str) -> DataFrame:
    """The long form of packed vectors: pos, region, region_class, r, s, mutable."""
    lists = [("r", T.ArrayType(T.IntegerType())), ("s", T.ArrayType(T.IntegerType())), ("mutable", T.ArrayType(T.BooleanType()))]
    rows = _batchwise(vectors, ("sequence_id", *carried), lists, lambda batch: [pa.array(list(x)) for x in _unpacked(batch)])
    rows = rows.select("sequence_id", *carried, F.posexplode(F.arrays_zip("r", "s", "mutable")).alias("i", "x"))
    region, kind = _place("i + 1")
    return rows.select("sequence_id", *carried, F.expr("i + 1").alias("pos"), F.expr(region).alias("region"), F.expr(kind).alias("region_class"), "x.r", "x.s", "x.mutable")


def _counts() -> list[Column]:
    mutated = lambda c: F.sum(F.when(F.col(c) > 0, 1).otherwise(0))
    return [F.sum("r").alias("r"), F.sum("s").alias("s"), mutated("r").alias("r_aa"), mutated("s").alias("s_aa")]


def row_counts(positions: DataFrame) -> DataFrame:
    """Per sequence: mutations, and mutated positions (aa), replacement and silent."""
    return positions.groupBy("sequence_id").agg(*_counts())


def row_region_counts(positions: DataFrame) -> DataFrame:
    return positions.groupBy("sequence_id", "region").agg(*_counts())


def weights(rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """sequence_id, by and the weight ``w`` of the rows."""
    return rows.select("sequence_id", *by, weight().alias("w"))


def summed(positions: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """by, pos, region, region_class and weighted sums of positions that carry ``by`` and ``w``.

    A position that can mutate adds the weight to its aa total and three times it to its nt total."""
    w = F.col("w")
    aa = lambda c: F.sum(F.when(F.col(c) > 0, w).otherwise(0))
    total = F.sum(F.when(F.col("mutable"), w).otherwise(0))
    return positions.groupBy(*by, "pos", "region", "region_class").agg(
        F.sum(F.col("r") * w).alias("r"), F.sum(F.col("s") * w).alias("s"), aa("r").alias("r_aa"), aa("s").alias("s_aa"), (3 * total).alias("total"), total.alias("total_aa"))


_PARTS = ("r", "s", "ra", "sa", "t")


def _added(w: np.ndarray, r: np.ndarray, s: np.ndarray, mutable: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """n keys by parts by positions: the rows' weighted sums."""
    order = np.argsort(key, kind="stable")
    starts, w = np.searchsorted(key[order], np.arange(n)), w[order, None]
    most = max(int(x.max(initial=1)) - min(0, int(x.min(initial=0))) for x in (r, s)) * (int(w.max()) - min(0, int(w.min()))) * len(w)
    if most < 2**24:  # whole numbers that small are exact in float32, however they are added
        cells, w = np.concatenate([r, s, r > 0, s > 0, mutable], axis=1)[order], w[:, 0].astype(np.float32)
        return np.stack([w[a:b] @ cells[a:b].astype(np.float32) for a, b in zip(starts, [*starts[1:], len(w)], strict=True)]).astype(np.int64).reshape(n, len(_PARTS), -1)
    w = w.astype(object) if most >= 2**62 else w  # no sum wraps: what fits no long fails as it does in Spark
    return np.stack([np.add.reduceat(x[order] * w, starts, axis=0) for x in (r, s, r > 0, s > 0, mutable)], axis=1)


def summed_vectors(vectors: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """As ``summed``, from packed vectors that carry ``by`` and ``w``."""
    return _summed_batches(vectors.select(*by, "w", "r", "s", "mutable"), _unpacked, by)


def summed_rows(rows: DataFrame, counts: Counts, by: tuple[str, ...], read: Work = _region_columns) -> DataFrame:
    """``summed_vectors`` of ``packed_rows`` that carry ``by`` and ``w``: a batch's vectors are added in the task that
    makes them."""
    return _summed_batches(rows, lambda batch: _vectors(counts, read(batch), batch), by)


def _summed_batches(rows: DataFrame, vectors: Vectors, by: tuple[str, ...]) -> DataFrame:
    names = [f"{n}{i}" for n in _PARTS for i in range(CHUNK)]
    made = T.StructType([*rows.select(*by).schema.fields, T.StructField("k", T.IntegerType()), *[T.StructField(n, T.LongType()) for n in names]])

    def passed_on(places: dict[tuple, int], sums: np.ndarray, kinds: list[pa.DataType]) -> pa.RecordBatch:
        chunks = POSITIONS // CHUNK
        cells = sums[: len(places)].reshape(len(places), len(_PARTS), chunks, CHUNK).transpose(0, 2, 1, 3).reshape(-1, len(names))
        again = np.repeat(np.arange(len(places)), chunks)
        keys = [pa.array(x, t).take(pa.array(again)) for x, t in zip(zip(*places, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([*keys, pa.array(np.tile(np.arange(chunks, dtype=np.int32), len(places))), *[pa.array(x, pa.int64()) for x in cells.T]], [*by, "k", *names])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, sums, kinds = {}, np.zeros((0, len(_PARTS), POSITIONS), np.int64), []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c) for c in by]
            kinds = [c.type for c in columns]
            first, key = aligned.groups(columns, batch.num_rows)
            found = _added(np.asarray(batch.column("w").fill_null(0)).astype(np.int64), *vectors(batch), key, len(first))
            values = zip(*[c.take(pa.array(first)).to_pylist() for c in columns], strict=True) if by else [()]
            at = [places.setdefault(tuple(tuple(x) if isinstance(x, list) else x for x in v), len(places)) for v in values]
            if len(places) > len(sums):
                sums = np.concatenate([sums, np.zeros((max(len(places), 2 * len(sums)) - len(sums), *sums.shape[1:]), sums.dtype)])
            if found.dtype == object or sums.dtype == object or max(np.abs(found).max(), np.abs(sums).max()) >= 2**61:
                sums = sums.astype(object)
            sums[at] += found
            if len(places) >= KEPT:
                yield passed_on(places, sums, kinds)
                places, sums = {}, np.zeros((0, len(_PARTS), POSITIONS), np.int64)
        if places:
            yield passed_on(places, sums, kinds)

    parts = rows.mapInArrow(work, made).groupBy(*by, "k").agg(*[F.sum(n).alias(n) for n in names])
    entries = ", ".join(f"struct(k * {CHUNK} + {i + 1} AS pos, r{i} AS r, s{i} AS s, ra{i} AS r_aa, sa{i} AS s_aa, 3 * t{i} AS total, t{i} AS total_aa)" for i in range(CHUNK))
    region, kind = _place("pos")
    return parts.select(*by, F.expr(f"inline(array({entries}))")).select(*by, "pos", F.expr(region).alias("region"), F.expr(kind).alias("region_class"), *SUMS)


def added(sums: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Sums by position of finer keys, added by ``by``."""
    return sums.groupBy(*by, "pos", "region", "region_class").agg(*[F.sum(c).alias(c) for c in SUMS])


def weighted(positions: DataFrame, rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """``summed`` for a table that is long already. Where the sequences are at hand, join ``weights`` to
    them and sum packed vectors (``summed_vectors``): that join has a row per sequence, this one a row
    per position."""
    return summed(positions.join(weights(rows, by), "sequence_id"), by)


def keyed_rows(rows: DataFrame, key: str) -> DataFrame:
    """Rows with ``key``: repertoire_id, clone_id (null: left out), or a segment at a level such as
    v_call, j_gene (ambiguous calls stay one comma-joined key)."""
    if key in ("repertoire_id",):
        return rows
    if key == "clone_id":
        return rows.where("clone_id is not null")
    segment, name = key.split("_")
    return rows.withColumn("segment", at_level(segment, {"call": "allele"}.get(name, name))).where("segment <> ''")


def rolled_up(by_position: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """by, scope (position, region, class or global), part and the sums."""
    plain = by_position.groupingSets([[*map(F.col, by), F.col("pos")], [*map(F.col, by), F.col("region")], [*map(F.col, by), F.col("region_class")], [*map(F.col, by)]], *by, "pos", "region", "region_class") if by else \
        by_position.groupingSets([[F.col("pos")], [F.col("region")], [F.col("region_class")], []], "pos", "region", "region_class")
    summed = plain.agg(*[F.sum(c).alias(c) for c in SUMS], F.grouping("pos").alias("g_pos"), F.grouping("region").alias("g_region"), F.grouping("region_class").alias("g_class"))
    scope = F.when(F.col("g_pos") == 0, "position").when(F.col("g_region") == 0, "region").when(F.col("g_class") == 0, "class").otherwise("global")
    part = F.when(F.col("g_pos") == 0, F.col("pos").cast("string")).when(F.col("g_region") == 0, F.col("region")).when(F.col("g_class") == 0, F.col("region_class")).otherwise("all")
    return summed.select(*by, scope.alias("scope"), part.alias("part"), *SUMS)


def sequence_totals(rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("mu_seq_count"), F.sum(weight()).alias("mu_duplicate_count"))


def unique_positions(by_position: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Number of positions with any replacement or silent mutation."""
    seen = lambda c: F.sum(F.when(F.col(c) > 0, 1).otherwise(0))
    return by_position.groupBy(*by).agg(seen("r_aa").alias("mu_unique_r"), seen("s_aa").alias("mu_unique_s"))


def _share(n: Column, total: Column) -> Column:
    return F.when(total == 0, 0.0).otherwise(n / total)


def frequencies(rolled: DataFrame, by: tuple[str, ...], *carried: str) -> DataFrame:
    """by, scope, part, carried columns, freq_r, freq_s, freq (and _aa): mutations by mutable letters; 0 where there are none."""
    out = []
    for suffix in ("", "_aa"):
        total = F.col(f"total{suffix}")
        r, s = _share(F.col(f"r{suffix}"), total), _share(F.col(f"s{suffix}"), total)
        out += [r.alias(f"freq_r{suffix}"), s.alias(f"freq_s{suffix}"), (r + s).alias(f"freq{suffix}")]
    return rolled.select(*by, "scope", "part", *carried, *out)


def region_ratios(rolled: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """by, region_class, share of all mutations (ratio, ratio_r, ratio_s) and R/S ratio, nt and aa.

    R/S: 0/0 is NaN, x/0 infinite."""
    whole = rolled.where("scope = 'global'").select(*by, *[F.col(c).alias(f"all_{c}") for c in ("r", "s", "r_aa", "s_aa")])
    parts = rolled.where("scope = 'class'")
    joined = parts.join(whole, list(by)) if by else parts.crossJoin(whole)
    out = []
    for x in ("", "_aa"):
        r, s, ar, as_ = F.col(f"r{x}"), F.col(f"s{x}"), F.col(f"all_r{x}"), F.col(f"all_s{x}")
        rs = F.when((r == 0) & (s == 0), F.lit(float("nan"))).when(s == 0, F.lit(float("inf"))).otherwise(r / s)
        out += [_share(r + s, ar + as_).alias(f"ratio{x}"), _share(r, ar).alias(f"ratio_r{x}"), _share(s, as_).alias(f"ratio_s{x}"), rs.alias(f"rsratio{x}")]
    return joined.select(*by, F.col("part").alias("region_class"), *out)


def _statistics(long: DataFrame, keys: list[str]) -> DataFrame:
    """keys, N, avg, std of ``value`` over the repertoires; null values are left out, avg 0 where none is left."""
    lists = long.groupBy(*keys).agg(by_repertoire(F.col("value")).alias("_values"))
    found = lists.withColumn("_values", F.filter("_values.value", lambda x: x.isNotNull()))
    return found.select(*keys, F.size("_values").cast("bigint").alias("N"), mean_std(F.col("_values")).alias("_m")).select(*keys, "N", F.coalesce("_m.avg", F.lit(0.0)).alias("avg"), F.coalesce("_m.std", F.lit(0.0)).alias("std"))


def group_frequencies(rolled: DataFrame) -> DataFrame:
    """repertoire_group_id, scope, part, field, N, avg, std over the members' frequencies. ``rolled``: by
    group and repertoire, of the rows that pass the group's filter.

    A member whose total at that place is 0 is left out and N shrinks; a member without rows is never
    in N; std 0 for N <= 1, avg 0 for N = 0."""
    by = ("repertoire_group_id", "repertoire_id")
    freq = frequencies(rolled, by, "total", "total_aa")
    fields = ", ".join(f"'{f}', {f}, {t}" for f, t in (("freq", "total"), ("freq_r", "total"), ("freq_s", "total"), ("freq_aa", "total_aa"), ("freq_r_aa", "total_aa"), ("freq_s_aa", "total_aa")))
    long = freq.select(*by, "scope", "part", F.expr(f"stack(6, {fields}) AS (field, value, n)"))
    x = F.when(F.col("n") > 0, F.col("value"))
    return _statistics(long.withColumn("value", x), ["repertoire_group_id", "scope", "part", "field"])


RATIOS = ("ratio", "ratio_r", "ratio_s", "rsratio", "ratio_aa", "ratio_r_aa", "ratio_s_aa", "rsratio_aa")


def group_ratios(ratios: DataFrame) -> DataFrame:
    """Group mean and deviation of the members' ratios (by group and repertoire): all members with rows;
    NaN and infinity carry over."""
    long = ratios.select("repertoire_group_id", "repertoire_id", "region_class", F.expr("stack({}, {}) AS (field, value)".format(len(RATIOS), ", ".join(f"'{n}', {n}" for n in RATIOS))))
    return _statistics(long, ["repertoire_group_id", "region_class", "field"])


def wide_counts(rolled: DataFrame, by: tuple[str, ...], totals: DataFrame | None = None, unique: DataFrame | None = None) -> DataFrame:
    """The wide count report: mu_count_* and mu_total_count_* by position, region and in all (totals by
    class too), with the columns of ``sequence_totals`` and ``unique_positions`` where these are given."""
    pieces = []
    for c, head, tail in (("r", "mu_count_", "_r"), ("s", "mu_count_", "_s"), ("r_aa", "mu_count_", "_r_aa"), ("s_aa", "mu_count_", "_s_aa"), ("total", "mu_total_count_", ""), ("total_aa", "mu_total_count_", "_aa")):
        name = F.when(F.col("part") == "all", F.lit((head + tail).replace("__", "_").rstrip("_"))).otherwise(F.concat(F.lit(head), "part", F.lit(tail)))
        pieces.append(F.struct(name.alias("name"), F.col(c).cast("bigint").alias("value")))
    long = rolled.select(*by, F.explode(F.array(*pieces)).alias("x")).select(*by, "x.*")
    parts = [*map(str, range(1, POSITIONS + 1)), *REGIONS, "fwr", "cdr"]
    columns = [f"mu_count_{p}_{k}" for p in parts[:-2] for k in ("r", "s", "r_aa", "s_aa")] + [f"mu_total_count_{p}{k}" for p in parts for k in ("", "_aa")] + ["mu_count_r", "mu_count_s", "mu_count_r_aa", "mu_count_s_aa", "mu_total_count", "mu_total_count_aa"]
    wide = long.groupBy(*by).pivot("name", columns).agg(F.first("value"))
    for more in (totals, unique):
        if more is not None:
            wide = wide.join(more, list(by), "left")
    return wide


def _frequency_name(field: Column | str) -> Column:
    """mu_{field}, the place between the head and its _r, _s, _aa: mu_freq_{part}_r."""
    f = F.col(field) if isinstance(field, str) else field
    return F.concat(F.lit("mu_freq"), F.when(F.col("part") == "all", "").otherwise(F.concat(F.lit("_"), "part")), F.regexp_replace(f, "^freq", ""))


def _ratio_name(field: Column | str) -> Column:
    f = F.col(field) if isinstance(field, str) else field
    return F.concat(F.lit("mu_"), F.regexp_extract(f, "^(rs)?ratio", 0), F.lit("_"), "region_class", F.regexp_replace(f, "^(rs)?ratio", ""))


def frequency_columns() -> list[str]:
    """The names of the wide frequency report, in order."""
    fields = [k + x for x in ("", "_aa") for k in ("", "_r", "_s")]
    parts = ["", "_fwr", "_cdr", *[f"_{r}" for r in REGIONS]]
    names = [f"mu_freq{p}{k}" for p in parts for k in fields] + [f"mu_freq_{p}{k}{x}" for p in range(1, POSITIONS + 1) for x in ("", "_aa") for k in ("_r", "_s")]
    return names + [f"mu_{head}_{c}{tail}" for c in ("fwr", "cdr") for x in ("", "_aa") for head, tail in (("ratio", x), ("ratio", f"_r{x}"), ("ratio", f"_s{x}"), ("rsratio", x))]


def wide_frequencies(frequency: DataFrame, ratios: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """The wide frequency report: mu_freq_* in all, by region, class and position, mu_ratio_* and mu_rsratio_*."""
    entry = lambda name, f: F.struct(name(F.lit(f)).alias("name"), F.col(f).alias("value"))
    fields = [f"freq{k}{x}" for x in ("", "_aa") for k in ("", "_r", "_s")]
    long = frequency.select(*by, F.explode(F.array(*[entry(_frequency_name, f) for f in fields])).alias("x")).select(*by, "x.*")
    long = long.unionAll(ratios.select(*by, F.explode(F.array(*[entry(_ratio_name, f) for f in RATIOS])).alias("x")).select(*by, "x.*"))
    return long.groupBy(*by).pivot("name", frequency_columns()).agg(F.first("value"))


def wide_group_frequencies(rolled: DataFrame) -> DataFrame:
    """The wide group report, a row per group: N (members with rows), and _avg, _std and _N of every column
    of the wide frequency report. ``rolled``: by group and repertoire."""
    values = ("avg", "std", "N")
    stats = group_frequencies(rolled).withColumn("name", _frequency_name("field")).select("repertoire_group_id", "name", *values)
    ratios = group_ratios(region_ratios(rolled, ("repertoire_group_id", "repertoire_id"))).withColumn("name", _ratio_name("field")).select("repertoire_group_id", "name", *values)
    entries = F.array(*[F.struct(F.concat("name", F.lit(f"_{v}")).alias("name"), F.col(v).cast("double").alias("value")) for v in values])
    long = stats.unionAll(ratios).select("repertoire_group_id", F.explode(entries).alias("x")).select("repertoire_group_id", "x.*")
    wide = long.groupBy("repertoire_group_id").pivot("name", [f"{c}_{v}" for c in frequency_columns() for v in values]).agg(F.first("value"))
    return rolled.where("scope = 'global'").groupBy("repertoire_group_id").agg(F.count("*").alias("N")).join(wide, "repertoire_group_id")


_COUNTS = ("r", "s", "r_aa", "s_aa")


def _vector_counts(r: np.ndarray, s: np.ndarray, where: slice) -> list[np.ndarray]:
    """r, s, r_aa, s_aa of each row: mutations and mutated positions of a slice."""
    r, s = r[:, where], s[:, where]
    return [r.sum(axis=1, dtype=np.int64), s.sum(axis=1, dtype=np.int64), np.count_nonzero(r > 0, axis=1), np.count_nonzero(s > 0, axis=1)]


def region_slices() -> dict[str, slice]:
    return {r: slice(first - 1, last) for r, (first, last) in REGIONS.items()}


def row_vector_counts(vectors: DataFrame) -> DataFrame:
    """As ``row_counts``, row by row from packed vectors: nothing is shuffled."""
    work = lambda batch: [pa.array(x, pa.int64()) for x in _vector_counts(*_unpacked(batch)[:2], slice(None))]
    return _batchwise(vectors.select("sequence_id", *_names(_VECTORS)), ("sequence_id",), [(c, T.LongType()) for c in _COUNTS], work)


def row_region_vector_counts(vectors: DataFrame) -> DataFrame:
    """As ``row_region_counts``, row by row from packed vectors."""
    parts = region_slices()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r, s, _ = _unpacked(batch)
            for region, where in parts.items():
                yield pa.RecordBatch.from_arrays([batch.column("sequence_id"), pa.array([region]).take(pa.array(np.zeros(len(r), np.int64))), *[pa.array(x, pa.int64()) for x in _vector_counts(r, s, where)]], ["sequence_id", "region", *_COUNTS])

    made = T.StructType([vectors.schema["sequence_id"], T.StructField("region", T.StringType()), *[T.StructField(c, T.LongType()) for c in _COUNTS]])
    return vectors.select("sequence_id", *_names(_VECTORS)).mapInArrow(run, made)


def mutation_vector_rows(vectors: DataFrame, *columns: str) -> DataFrame:
    """As ``mutation_rows``, row by row from packed vectors that carry the aligned regions and ``columns``."""
    parts = [("", slice(None)), *[(f"_{r}", s) for r, s in region_slices().items()]]
    made = [*_LETTERS, *_LENGTHS, *[(f"mu_count{tail}_{c}", T.LongType()) for tail, _ in parts for c in _COUNTS]]

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        r, s, _ = _unpacked(batch)
        counts = [pa.array(x, pa.int64()) for _, where in parts for x in _vector_counts(r, s, where)]
        regions = _region_columns(batch)
        return [*_region_letters(regions), *_region_lengths(regions), *counts]

    return _batchwise(vectors, ("sequence_id", *columns), made, work)


def _names(fields: list[tuple[str, T.DataType]]) -> list[str]:
    return [n for n, _ in fields]


def mutation_rows(rows: DataFrame, regions: DataFrame, positions: DataFrame) -> DataFrame:
    """The rearrangement-level table: the row's columns, translated regions, mutable letters and codons
    by region, mutations in all and by region (mu_count_{region}_{r,s,r_aa,s_aa}; 0 where none)."""
    counts = ("r", "s", "r_aa", "s_aa")
    mutated = lambda c, where: F.sum(F.when(where & (F.col(c) > 0), 1).otherwise(0))
    every = []
    for tail, where in (("", F.lit(True)), *((f"_{r}", F.col("region") == r) for r in REGIONS)):
        for c in counts:
            n = mutated(c[0], where) if c.endswith("_aa") else F.sum(F.when(where, F.col(c)).otherwise(0))
            every.append(n.alias(f"mu_count{tail}_{c}"))
    counted = positions.groupBy("sequence_id").agg(*every)
    return rows.join(region_translations(regions), "sequence_id").join(region_lengths(regions), "sequence_id").join(counted, "sequence_id")
