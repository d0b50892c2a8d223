"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraph cells. SQL functions only.

A text is cut into paragraph pieces (at line breaks, behind sentences, and inside a sentence behind
words that end in one of a few letters, so that cuts depend on nearby text alone). Each piece's digest is added
to three cells of a sketch; a cell holds a count, the XOR of its digests and the XOR of their
checks. Sketches are linear: subtracting one version's cells from the other's leaves the digests
that differ, which peeling recovers from the cells that hold a single one. Where peeling stalls
the two versions are sketched again with twice the cells.

Sketches hold every digest of a text. A fingerprint is the sketch in writing; its cells grow with the
number of digests, a quarter of it at least. ``likeness`` is 2*common/(both) over whole digest sets,
from the digests that peeling recovers from the difference of two sketches. The few pairs where
peeling stalls (two digests that share all three cells) are sketched again with ``LARGER`` times the
cells, up to ``RETRIES`` times; past that the sets are compared.

Cells are rows, so that empty ones cost nothing: sketches, subtraction and each round of peeling are
hash aggregates over the cells of a document, in the task that holds the document. A round peels one
third of the cells, where a digest has one cell, so that none is taken twice. Retries, and
``differing`` (which names the digests), do the same on arrays.

Defined results: null text counts as empty; a text without pieces has an empty sketch, and two
such texts have likeness 1; equal texts have equal fingerprints; ties in doc_id follow the text's
order and null doc_ids come last; other columns pass through ``with_next`` and ``fingerprint``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lymphoframe.llm.common import cut, let, partitions, table

#: Fixed value: where a text is cut: at line breaks and CJK full stops, and at a space behind one of these.
CUT = r"[\n。！？]+|\x20(?<=[.!?;:|%gpß]\x20)"
#: Cells of a third for each digest of a pair, and the least number of them.
ROOM, LEAST = 16, 4096
ROUNDS_OF_ROWS = 5
LARGER, RETRIES = 4, 4
LARGE = (48, 192, 768, 3072, 12288)
ROUNDS = 12
_CELL = "struct<cell:int,n:int,key:bigint,check:bigint>"
_EMPTY = f"cast(array() as array<{_CELL}>)"


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of the text's paragraph pieces."""
    pieces = F.filter(F.split(text, CUT, -1), lambda p: p != "")
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(7)).bitwiseAND(F.lit(0xFFFFFFFF))


def _third(cells: int | Column) -> Column:
    return F.lit(cells // 3) if isinstance(cells, int) else F.floor(cells / 3)


def _entries(key: Column, sign: Column, third: Column) -> Column:
    place = lambda j: (F.pmod(F.xxhash64(key, F.lit(j)), third) + j * third).cast("int")
    return F.array(*[F.struct(place(j).alias("cell"), sign.cast("int").alias("n"), key.alias("key"), _check(key).alias("check")) for j in range(3)])


def _combine(entries: Column) -> Column:
    """Sum the entries of each cell; cells that come to nothing are left out."""

    def total(e, first, stop):
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("key"), F.lit(0).cast("bigint").alias("check"))
        add = lambda a, x: F.struct((a["n"] + x["n"]).alias("n"), a["key"].bitwiseXOR(x["key"]).alias("key"), a["check"].bitwiseXOR(x["check"]).alias("check"))
        return let(F.aggregate(F.slice(e, first + 1, stop - first), zero, add), lambda s: F.struct(
            F.get(e, first)["cell"].alias("cell"), s["n"].alias("n"), s["key"].alias("key"), s["check"].alias("check")))

    def of(e):
        starts = F.filter(F.sequence(F.lit(0), F.size(e) - 1), lambda i: (i == 0) | (F.get(e, i)["cell"] != F.get(e, i - 1)["cell"]))
        sums = let(starts, lambda s: F.transform(s, lambda first, k: total(e, first, F.coalesce(F.get(s, k + 1), F.size(e)))))
        live = F.filter(sums, lambda c: (c["n"] != 0) | (c["key"] != 0) | (c["check"] != 0))
        return F.when(F.size(e) > 0, live).otherwise(F.expr(_EMPTY))

    return let(F.sort_array(entries), of)


def sketch(keys: Column, cells: int | Column) -> Column:
    """The non-empty cells of the keys' sketch, by cell."""
    return let(_third(cells), lambda third: _combine(F.flatten(F.transform(keys, lambda k: _entries(k, F.lit(1), third)))))


def subtract(a: Column, b: Column) -> Column:
    flipped = F.transform(b, lambda c: F.struct(c["cell"], (-c["n"]).alias("n"), c["key"], c["check"]))
    return _combine(F.concat(a, flipped))


def peel(cells: Column, size: int | Column) -> Column:
    """array<struct<key,n>> of all digests left in the cells (n: 1 or -1), or null where it stalls."""
    start = F.struct(cells.alias("cells"), F.expr("cast(array() as array<struct<key:bigint,n:int>>)").alias("got"))

    def step(acc, _):
        pure = F.filter(acc["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["check"] == _check(c["key"])))
        of = lambda n: F.transform(F.array_distinct(F.transform(F.filter(pure, lambda c: c["n"] == n), lambda c: c["key"])), lambda k: F.struct(k.alias("key"), F.lit(n).alias("n")))
        keys = F.concat(of(1), of(-1))

        def taken(ks):
            out = F.flatten(F.transform(ks, lambda k: _entries(k["key"], -k["n"], _third(size))))
            return F.when(F.size(ks) == 0, acc).otherwise(F.struct(_combine(F.concat(acc["cells"], out)).alias("cells"), F.concat(acc["got"], ks).alias("got")))

        return let(keys, taken)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda acc: F.when(F.size(acc["cells"]) == 0, acc["got"]))


def differing(a: Column, b: Column, sizes: tuple[int, ...] = LARGE) -> Column:
    """array<struct<key,n>>: digests only in ``a`` (n=1) or only in ``b`` (n=-1). Each size is tried
    only where the one before stalled; past the last the digest sets themselves are compared."""
    tries = [peel(subtract(sketch(a, m), sketch(b, m)), m) for m in sizes]
    only = lambda x, y, n: F.transform(F.array_except(x, y), lambda k: F.struct(k.alias("key"), F.lit(n).alias("n")))
    return F.coalesce(*tries, F.concat(only(a, b, 1), only(b, a, -1)))


def _cells(number: Column) -> Column:
    """The smallest 48 * 2**k of at least ``number``."""
    return F.call_function("shiftleft", F.lit(LARGE[0]), F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(number, F.lit(1)) / F.lit(float(LARGE[0]))))).cast("int"))


def _first_third(a: Column, b: Column) -> Column:
    """Cells of a third: the smallest LEAST * 2**k with ``ROOM`` for each digest."""
    need = F.greatest(F.ceil(F.log2(F.greatest(F.size(a) + F.size(b), F.lit(1)) * (ROOM / LEAST))), F.lit(0)).cast("int")
    return F.call_function("shiftleft", F.lit(LEAST).cast("bigint"), need)


def n_differing(a: Column, b: Column) -> Column:
    """Size of the difference where the first sketches stalled: larger ones, then the sets."""

    def again(first: Column) -> Column:
        once = lambda m: F.size(peel(subtract(sketch(a, m), sketch(b, m)), m))
        step = lambda got, k: F.when(got.isNotNull(), got).otherwise(let(F.call_function("shiftleft", first, (LARGER.bit_length() - 1) * k), once))
        # the size of null is null, so a stalled try leaves the way open for the next
        return F.aggregate(F.sequence(F.lit(1), F.lit(RETRIES)), F.lit(None).cast("int"), step)

    return F.coalesce(let(3 * _first_third(a, b), again), F.size(F.array_except(a, b)) + F.size(F.array_except(b, a)))


def _summed(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells of equal keys added up; cells that come to nothing are left out."""
    return cells.groupBy(*keys).agg(F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("check").alias("check")).where("n <> 0 or key <> 0 or check <> 0")


def _place(j: Column) -> Column:
    return F.pmod(F.xxhash64("key", j), F.col("third")) + j * F.col("third")


def compared(keyed: DataFrame, by: list[str], prints: list[str], pairs: list[tuple[str, str]], carried: list[str]) -> DataFrame:
    """``by``, the ``carried`` columns (bigint), print_0, ... (the fingerprints of the columns' digests) and
    near_0, left_0, ...: likeness by the digests recovered from the difference of each pair, and cells
    that peeling could not empty. ``keyed`` is partitioned by some of ``by``, which keeps all of it in
    its task; what is carried travels as cells of its own, so no join is needed."""
    m, numbers = len(pairs), [F.lit(j).cast("bigint") for j in range(3)]
    xor = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, k: a.bitwiseXOR(k))
    values = {c: F.col(c) for c in carried} | {f"_size_{c}": F.size(c).cast("bigint") for c in {*prints, *(x for p in pairs for x in p)}} | {f"_xor_{c}": xor(c) for c in prints}

    def entry(pair: int, third: Column, n: Column, key: Column) -> Column:
        return F.struct(F.lit(pair).alias("pair"), third.cast("bigint").alias("third"), n.cast("bigint").alias("n"), key.alias("key"))

    def side(p: int, third: Column, keys: str, n: int) -> Column:
        return F.transform(keys, lambda k: entry(p, third, F.lit(n), k))

    def both(p: int, a: str, b: str) -> Column:
        return let(_first_third(F.col(a), F.col(b)), lambda t: F.concat(side(p, t, a, 1), side(p, t, b, -1)))

    def sketched(p: int, keys: str) -> Column:
        return let(F.floor(_cells(F.size(keys) / 4) / 3), lambda t: side(p, t, keys, 1))

    head = F.array(*[entry(-1, F.lit(k), F.when(v.isNull(), 2).otherwise(1), F.coalesce(v, F.lit(0).cast("bigint"))) for k, v in enumerate(values.values())])
    entries = F.flatten(F.array(head, *[both(p, a, b) for p, (a, b) in enumerate(pairs)], *[sketched(m + p, c) for p, c in enumerate(prints)]))
    own = F.col("pair") < 0
    signed = keyed.select(*by, F.explode(entries).alias("x")).select(*by, "x.*").withColumn("j", F.explode(F.when(own, F.array(numbers[0])).otherwise(F.array(*numbers))))
    keys, cell = [*by, "pair", "third", "cell"], lambda at, n, key, check: F.struct(at.alias("cell"), n.cast("bigint").alias("n"), key.alias("key"), check.alias("check"))
    cells = _summed(signed.select(*by, "pair", "third", F.when(own, F.col("third")).otherwise(_place(F.col("j"))).alias("cell"), "n", "key", _check(F.col("key")).alias("check")), keys)
    zero = F.lit(0).cast("bigint")
    for k in range(ROUNDS_OF_ROWS):
        j = k % 3
        here = (F.col("pair") >= 0) & (F.col("pair") < m) & (F.col("cell") >= j * F.col("third")) & (F.col("cell") < (j + 1) * F.col("third"))
        pure = here & (F.abs("n") == 1) & (F.col("check") == _check(F.col("key")))
        out = [cell(_place(i), -F.col("n"), F.col("key"), F.col("check")) for i in (numbers[x] for x in range(3) if x != j)]
        taken = F.when(pure, F.array(cell(F.lit(-1).cast("bigint"), F.lit(1), zero, zero), *out)).otherwise(F.array(cell(F.col("cell"), F.col("n"), F.col("key"), F.col("check"))))
        cells = _summed(cells.select(*by, "pair", "third", F.explode(taken).alias("x")).select(*by, "pair", "third", "x.*"), keys)
    done, stats = F.col("cell") == -1, []
    for p in range(m):
        mine = F.col("pair") == p
        stats += [F.sum(F.when(mine & done, F.col("n")).otherwise(0)).alias(f"_got_{p}"), F.sum(F.when(mine & ~done, 1).otherwise(0)).alias(f"left_{p}")]
    stats += [F.max(F.when(own & (F.col("cell") == k) & (F.col("n") == 1), F.col("key"))).alias(c) for k, c in enumerate(values)]
    text = F.concat_ws(".", "cell", "n", F.lower(F.hex("key")), F.lower(F.hex("check")))
    stats += [F.array_sort(F.collect_list(F.when(F.col("pair") == m + p, F.struct("cell", text.alias("text"))))).alias(f"_cells_{p}") for p in range(len(prints))]
    found = cells.groupBy(*by).agg(*stats)
    near = []
    for p, (a, b) in enumerate(pairs):
        size = F.col(f"_size_{a}") + F.col(f"_size_{b}")
        near += [F.when(size > 0, (size - F.col(f"_got_{p}")) / size).otherwise(1.0).alias(f"near_{p}"), f"left_{p}"]
    written = [F.concat_ws(":", f"_size_{c}", F.lower(F.hex(f"_xor_{c}")), _cells(F.col(f"_size_{c}") / 4), F.array_join(F.col(f"_cells_{p}.text"), ",")).alias(f"print_{p}") for p, c in enumerate(prints)]
    return found.select(*by, *carried, *written, *near)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 by all digests of both sides, on arrays: for the few pairs that stalled."""
    both = F.size(a) + F.size(b)
    return F.when(both > 0, (both - n_differing(a, b)) / both).otherwise(1.0)


def fingerprint(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``fingerprint``. The sketches are made of the distinct texts."""
    keyed = df.select(F.coalesce(text, F.lit("")).alias("_text")).distinct().select(F.sha2("_text", 256).alias("_sha"), digests(F.col("_text")).alias("_keys"))
    made = compared(keyed.repartition("_sha"), ["_sha"], ["_keys"], [], []).select("_sha", F.col("print_0").alias("fingerprint"))
    return df.drop("fingerprint").withColumn("_sha", F.sha2(F.coalesce(text, F.lit("")), 256)).join(made, "_sha").drop("_sha")


#: Ranges for each shuffle partition: a task holds the cells of one range's documents.
RANGES = 8


def with_next(docs: DataFrame, order: list[str], *carried: str) -> DataFrame:
    """Adds ``next_<c>`` for each carried column: its value in the next row by descending doc_id
    (after the last: the first; ties by ``order``). Rows are dealt to ranges of doc_id whose bounds are
    quantiles (as many as a few times the shuffle partitions); the first row of each range is also
    dealt to the range before it, so no range needs another and no task sees more than its range. The
    result is partitioned by ``_range``, where ``_row`` numbers the rows."""
    n = RANGES * partitions(docs.sparkSession)
    by = [F.col("doc_id").desc_nulls_last(), *[F.col(c).asc() for c in order]]
    found = docs.where("doc_id is not null").approxQuantile("doc_id", [i / n for i in range(1, n)], 0.25 / n) if n > 1 else []
    bounds = sorted({int(x) for x in found}, reverse=True)
    dealt = docs.withColumn("_range", F.when(F.col("doc_id").isNull(), len(bounds)).otherwise(_range(F.col("doc_id"), bounds))).withColumn("_halo", F.lit(0))
    every = Window.orderBy("_range")  # one row a range
    heads = dealt.groupBy("_range").agg(F.max("doc_id").alias("_head"))
    around = heads.select(F.coalesce(F.lag("_range").over(every), F.max("_range").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_to"), "_head")
    halo = docs.join(F.broadcast(around), F.col("doc_id").eqNullSafe(F.col("_head"))).withColumn("_range", F.col("_to")).withColumn("_halo", F.lit(1)).select(*dealt.columns)
    near = Window.partitionBy("_range").orderBy("_halo", *by)
    out = dealt.unionByName(halo).repartition(n, "_range").withColumn("_row", F.row_number().over(near))
    for c in carried:
        out = out.withColumn(f"next_{c}", F.lead(c).over(near))
    return out.where("_halo = 0").drop("_halo")


def _range(value: Column, bounds: list[int]) -> Column:
    """Number of bounds (descending) above the value, by binary search."""
    if not bounds:
        return F.lit(0)
    limits = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def step(a, _):
        mid = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
        above = F.get(limits, mid) > value
        return F.when(a["lo"] >= a["hi"], a).when(above, F.struct((mid + 1).alias("lo"), a["hi"].alias("hi"))).otherwise(F.struct(a["lo"].alias("lo"), mid.alias("hi")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(len(bounds).bit_length())), start, step, lambda a: a["lo"])


def _rows(docs: DataFrame) -> DataFrame:
    """Documents with their edited text's hash, and the digests of both and of the next document's text."""
    rows = with_next(docs.withColumn("keys", digests(F.col("text"))), ["text"], "text", "keys").withColumn("n_chars", F.length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substr("next_text", F.lit(1), half)))
    return rows.select("_range", "_row", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "keys", digests(F.col("edited")).alias("edited_keys"), "next_keys")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    by, shas = ["_range", "_row"], [f"_sha{k}" for k in range(4)]
    keyed = rows.select("*", *[F.conv(F.substring("edited_sha256", 16 * k + 1, 16), 16, -10).cast("bigint").alias(c) for k, c in enumerate(shas)])
    found = compared(keyed, by, ["keys", "edited_keys"], [("keys", "edited_keys"), ("keys", "next_keys")], ["doc_id", "n_chars", *shas])
    sha = F.concat(*[F.lpad(F.lower(F.hex(c)), 16, "0") for c in shas])
    found = cut(found.select(*by, "doc_id", "n_chars", sha.alias("edited_sha256"), F.col("print_0").alias("fingerprint"), F.col("print_1").alias("edited_fingerprint"),
                             F.col("near_0").alias("near_edited"), F.col("near_1").alias("near_next"), (F.col("left_0") + F.col("left_1") > 0).alias("stalled")), "fingerprints")
    if not found.where("stalled").limit(1).count():
        return found.drop(*by, "stalled")
    again = rows.join(found.where("stalled").select(*by), by, "left_semi")
    near = again.select(*by, likeness(F.col("keys"), F.col("edited_keys")).alias("_edited"), likeness(F.col("keys"), F.col("next_keys")).alias("_next"))
    mended = found.where("stalled").join(near, by).withColumn("near_edited", F.col("_edited")).withColumn("near_next", F.col("_next"))
    return found.where("not stalled").unionByName(mended.select(found.columns)).drop(*by, "stalled")
