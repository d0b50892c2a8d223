"""Clones: assignment by key, summary, and the greedy merge of overlapping calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lymphoframe.functions.calls import at_level, is_productive, weight
from lymphoframe.tables import dropped, partitions, written

KEY = ["repertoire_id", "junction_aa", "v", "j"]


def takes_part() -> Column:
    """Productive rows of a T cell receptor locus with a junction."""
    return F.coalesce(F.col("locus").contains("TR") & is_productive() & (F.coalesce("junction_aa", F.lit("")) != ""), F.lit(False))


def clone_input(rows: DataFrame) -> DataFrame:
    return rows.where(takes_part())


def clone_key(level: str) -> dict[str, Column]:
    """junction_aa, v, j: the raw calls at allele level, comma-joined names at gene level."""
    v, j = (F.coalesce("v_call", F.lit("")), F.coalesce("j_call", F.lit(""))) if level == "allele" else (at_level("v", "gene"), at_level("j", "gene"))
    return {"junction_aa": F.col("junction_aa"), "v": v, "j": j}


def _keyed(resolved: DataFrame, level: str) -> DataFrame:
    return clone_input(resolved).withColumns({k: c for k, c in clone_key(level).items() if k != "junction_aa"})


def summed_clones(resolved: DataFrame, level: str, order: str = "sequence_id", dup_mode: str = "last") -> DataFrame:
    """repertoire_id, junction_aa, v, j, clone_count, duplicate_count, first_ord: one aggregate, no ids.

    duplicate_count is the last row's by ``order`` (``dup_mode="sum"``: their sum)."""
    dup = F.max_by(weight(), order) if dup_mode == "last" else F.sum(weight())
    return _keyed(resolved, level).groupBy(*KEY).agg(F.count("*").alias("clone_count"), dup.alias("duplicate_count"), F.min(order).alias("first_ord"))


def clones(resolved: DataFrame, level: str, order: str = "sequence_id", dup_mode: str = "last") -> DataFrame:
    """``summed_clones`` with ``clone_id``, counted up from 1 per repertoire in order of first appearance."""
    return numbered(summed_clones(resolved, level, order, dup_mode))


def numbered(found: DataFrame, ranges: int | None = None) -> DataFrame:
    """Adds ``clone_id``: 1, 2, ... per repertoire by ``first_ord`` (ties: by the clone's key).

    The clones are dealt to ranges of (repertoire, first_ord), sorted there and written once with their
    places; a repertoire of any size spreads over many ranges. A place counts from where the repertoire
    begins in its range, and the repertoire's clones in earlier ranges are added from a table of one
    row per repertoire and range."""
    order = ["repertoire_id", "first_ord", *[c for c in KEY[1:] if c in found.columns]]
    ranged = found.repartitionByRange(ranges or partitions(found.sparkSession), *order).sortWithinPartitions(*order)
    placed = written(ranged.withColumn("_place", F.monotonically_increasing_id()), "clones")
    split = placed.withColumn("_range", F.shiftright("_place", 33)).withColumn("_within", F.col("_place").bitwiseAND((1 << 33) - 1)).drop("_place")
    runs = split.groupBy("repertoire_id", "_range").agg(F.count("*").alias("_n"), F.min("_within").alias("_first"))
    earlier = F.sum("_n").over(Window.partitionBy("repertoire_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.select("repertoire_id", "_range", (F.coalesce(earlier, F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return split.join(starts, ["repertoire_id", "_range"]).withColumn("clone_id", F.col("_within") + F.col("_shift")).drop("_range", "_within", "_shift")


def assign(resolved: DataFrame, found: DataFrame, level: str) -> DataFrame:
    """The input rows with their clone's id."""
    rows = resolved.drop("clone_id") if "clone_id" in resolved.columns else resolved
    return _keyed(rows, level).join(found.select(*KEY, "clone_id"), KEY)


#: Clones of a junction that are merged in one array; of a junction with more, by rounds.
FEW = 64
_GROUP = ["repertoire_id", "junction_aa"]
_MERGED = [*_GROUP, "v", "j", "clone_count", "duplicate_count", "first_ord"]
_OUT = "array<struct<i:{},v:string,j:string,n:bigint,d:bigint>>"


def merge(found: DataFrame) -> DataFrame:
    """Greedy merge inside one (repertoire, junction): the clone with the largest duplicate_count (ties:
    the first) takes in every clone whose v and j lists both overlap its own; repeat with the rest.

    In other words: a clone that overlaps no seed before it is a seed, any other goes to the first seed
    it overlaps. Junctions with few clones do it in one fold, those with more by ``merge_by_rounds``."""
    base = written(found.select(*_GROUP, "v", "j", "clone_count", "duplicate_count", "first_ord"), "merge-clones")
    many = written(base.groupBy(*_GROUP).count().where(F.col("count") > FEW).select(*_GROUP), "merge-many")
    if many.isEmpty():
        return merge_by_fold(base)
    return merge_by_fold(base.join(many, _GROUP, "left_anti")).unionByName(merge_by_rounds(base.join(many, _GROUP, "left_semi")))


def merge_by_fold(found: DataFrame) -> DataFrame:
    """``merge`` where a junction's clones fit an array: one fold over them, sorted."""
    entry = F.struct((-F.col("duplicate_count")).alias("k"), F.col("first_ord").alias("i"), "v", "j", F.col("clone_count").alias("n"), F.col("duplicate_count").alias("d"))
    grouped = found.groupBy(*_GROUP).agg(F.array_sort(F.collect_list(entry)).alias("cl"))

    def hit(a: Column, b: Column) -> Column:
        both = lambda c: F.arrays_overlap(F.split(a[c], ","), F.split(b[c], ","))
        return both("v") & both("j")

    def step(acc: Column, c: Column) -> Column:
        at = F.array_position(F.transform(acc, lambda t: hit(t, c)), True)
        grown = F.transform(acc, lambda t, p: F.when(p == at - 1, F.struct(t["i"].alias("i"), t["v"].alias("v"), t["j"].alias("j"), (t["n"] + c["n"]).alias("n"), (t["d"] + c["d"]).alias("d"))).otherwise(t))
        fresh = F.array_append(acc, F.struct(c["i"].alias("i"), c["v"].alias("v"), c["j"].alias("j"), c["n"].alias("n"), c["d"].alias("d")))
        return F.when(at > 0, grown).otherwise(fresh)

    empty = F.expr(f"cast(array() as {_OUT.format(found.schema['first_ord'].dataType.simpleString())})")
    alone = F.transform("cl", lambda c: F.struct(c["i"].alias("i"), c["v"].alias("v"), c["j"].alias("j"), c["n"].alias("n"), c["d"].alias("d")))
    folded = F.when(F.size("cl") == 1, alone).otherwise(F.aggregate("cl", empty, step))
    merged = grouped.select(*_GROUP, F.explode(folded).alias("m"))
    return merged.select(*_GROUP, "m.v", "m.j", F.col("m.n").alias("clone_count"), F.col("m.d").alias("duplicate_count"), F.col("m.i").alias("first_ord"))


def merge_by_rounds(found: DataFrame) -> DataFrame:
    """``merge`` for junctions with any number of clones: the greedy maximal independent set, by rounds.

    Two clones overlap where they share a cell, a pair of a v and a j name; so in a cell each overlaps
    each, and only one can be a seed. In a round every clone that comes first in all its cells, among
    those not yet decided, is a seed, and all that share a cell with it are decided. At the end a clone
    goes to the first of the seeds in its cells. No junction's clones meet in one task: cells keep
    their least clone by partial aggregates, and a cell of very many clones is a join key that Spark splits."""
    cell = [*_GROUP, "cv", "cj"]
    names = lambda c: F.explode(F.array_distinct(F.split(c, ",")))
    key = F.struct((-F.col("duplicate_count")).alias("k"), F.col("first_ord").alias("i"), "v", "j").alias("key")
    cells = written(found.select(*_GROUP, key, names("v").alias("cv"), "j").select(*_GROUP, "key", "cv", names("j").alias("cj")), "merge-cells")
    left, seeded = cells, None
    while not left.isEmpty():
        least = written(left.groupBy(*cell).agg(F.min("key").alias("least")), "merge-least")
        seeds = left.join(least, cell).groupBy(*_GROUP, "key").agg(F.bool_and(F.col("key") == F.col("least")).alias("first")).where("first").select(*_GROUP, "key")
        # the cells of this round's seeds: where a seed is, it is the least of the cell
        homes = written(least.join(written(seeds, "merge-seeds").withColumnRenamed("key", "least"), [*_GROUP, "least"]).select(*cell, F.col("least").alias("seed")), "merge-homes")
        decided = written(left.join(homes, cell).select(*_GROUP, "key").distinct(), "merge-decided")
        rest = written(left.join(decided, [*_GROUP, "key"], "left_anti"), "merge-left")
        if left is not cells:
            dropped(left)
        dropped(least, decided)
        left, seeded = rest, homes if seeded is None else seeded.unionByName(homes)
    if seeded is None:
        return found.select(*_MERGED).limit(0)
    home = cells.join(written(seeded, "merge-seeded"), cell).groupBy(*_GROUP, "key").agg(F.min("seed").alias("seed"))
    own = found.select(*_GROUP, key, "clone_count", "duplicate_count")
    merged = own.join(home, [*_GROUP, "key"]).groupBy(*_GROUP, "seed").agg(F.sum("clone_count").alias("clone_count"), F.sum("duplicate_count").alias("duplicate_count"))
    return merged.select(*_GROUP, "seed.v", "seed.j", "clone_count", "duplicate_count", F.col("seed.i").alias("first_ord"))
