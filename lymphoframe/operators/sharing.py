"""Junctions shared between repertoires and groups.

``shares`` is the one aggregate over the rearrangements; everything else works on its rows, at most
one per junction and repertoire. Comparisons gather a junction's owners (an entry per repertoire or
group at most) and expand them, so no table is joined with itself: details expand owners by owners,
differences owners by the units that are none. Matrices need no expansion by junction: owners become a bitmap,
junctions with one bitmap are counted, and only the distinct bitmaps, few beside the junctions, are
expanded into pairs.

Units that are compared come from the metadata where it is given, so that one without any junction has its
zeros in a matrix and counts as an empty set in a difference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lymphoframe.functions.calls import is_productive, weight
from lymphoframe.tables import written

#: Level -> (segments whose first gene is part of the key, junction column).
SHARE_LEVELS = {"aa": ((), "junction_aa"), "nucleotide": ((), "junction"), "v,aa": (("v",), "junction_aa"), "v,nucleotide": (("v",), "junction"),
                "vj,aa": (("v", "j"), "junction_aa"), "vj,nucleotide": (("v", "j"), "junction")}
KEY = ["level", "gene_key", "cdr3"]
#: Units of one comparison at most: bitmaps have a bit for each. More are compared in parts.
MOST_UNITS = 4_096
#: Bits in a word of a bitmap.
WORD = 62


def share_key(level: str) -> dict[str, Column]:
    """gene_key, cdr3 of a row at a level (null gene_key: the row has no place there)."""
    segments, column = SHARE_LEVELS[level]
    genes = [F.try_element_at(f"{s}_gene", F.lit(1)) for s in segments]
    return {"gene_key": F.concat(*[x for g in genes for x in (F.lit("|"), g)][1:]) if genes else F.lit(""), "cdr3": F.col(column)}


def shares(resolved: DataFrame, levels: tuple[str, ...]) -> DataFrame:
    """level, gene_key, cdr3, repertoire_id, sequence_count, duplicate_count over productive rows.

    gene_key joins the first gene of each segment with ``|`` (empty at plain levels); rows whose v (or
    j) names no known gene are left out at the levels that need it; unknown levels are ignored."""
    entries = [F.struct(F.lit(level).alias("level"), *[c.alias(name) for name, c in share_key(level).items()]) for level in levels if level in SHARE_LEVELS]
    rows = resolved.where(is_productive()).select("repertoire_id", weight().alias("w"), F.explode(F.array(*entries)).alias("x"))
    return rows.where("x.cdr3 <> '' and x.gene_key is not null").groupBy("x.level", "x.gene_key", "x.cdr3", "repertoire_id").agg(F.count("*").alias("sequence_count"), F.sum("w").alias("duplicate_count"))


def group_shares(by_repertoire: DataFrame, members: DataFrame) -> DataFrame:
    """level, gene_key, cdr3, repertoire_group_id, share_level (members that have it) and their counts."""
    joined = by_repertoire.join(members.select("repertoire_group_id", "repertoire_id").distinct(), "repertoire_id")
    return joined.groupBy(*KEY, "repertoire_group_id").agg(F.count("*").alias("share_level"), F.sum("sequence_count").alias("sequence_count"), F.sum("duplicate_count").alias("duplicate_count"))


def share_summary(by_group: DataFrame) -> DataFrame:
    return by_group.groupBy("level", "repertoire_group_id", "share_level").agg(F.count("*").alias("n"))


def group_detail(by_repertoire: DataFrame, members: DataFrame) -> DataFrame:
    """The junctions of each group with the repertoires that have them and their counts, sorted by id.

    The list has an entry per member at most."""
    joined = by_repertoire.join(members.select("repertoire_group_id", "repertoire_id").distinct(), "repertoire_id")
    entry = F.struct("repertoire_id", "sequence_count", "duplicate_count")
    return joined.groupBy("repertoire_group_id", *KEY).agg(F.array_sort(F.collect_list(entry)).alias("repertoires"))


def unit_ids(units: DataFrame, unit: str) -> list[str]:
    """The ids of the compared units, sorted: a dimension, whose size is checked before it reaches the driver."""
    found = sorted(r[0] for r in units.select(unit).where(F.col(unit).isNotNull()).distinct().limit(MOST_UNITS + 1).collect())
    if len(found) > MOST_UNITS:
        raise ValueError(f"more than {MOST_UNITS} units: compare them in parts")
    return found


def owners(frame: DataFrame, unit: str, *columns: str) -> DataFrame:
    """level, gene_key, cdr3, ``owners``: the units that have the junction, with their columns, sorted by id."""
    return frame.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct(unit, *columns))).alias("owners"))


def _side(entry: str, side: str, *columns: str) -> list[Column]:
    return [F.col(f"{entry}.{c}").alias(f"{c}_{side}") for c in columns]


def _compared(frame: DataFrame, unit: str, *columns: str) -> DataFrame:
    """Ordered pairs of units with a junction in common, with both sides' columns: owners by owners."""
    found = owners(frame, unit, *columns).where(F.size("owners") > 1).select(*KEY, "owners", F.explode("owners").alias("a"))
    both = found.select(*KEY, "a", F.explode("owners").alias("b")).where(F.col(f"a.{unit}") != F.col(f"b.{unit}"))
    return both.select(*KEY, *_side("a", "a", unit, *columns), *_side("b", "b", unit, *columns))


def _lacking(found: DataFrame, unit: str, candidates: Column, pairs: list[tuple[str, str]] | None, *columns: str) -> DataFrame:
    """Owners by those of the ``candidates`` that aren't: only ``pairs`` (a, b) where these are given."""
    others = F.array_except(candidates, F.transform("owners", lambda o: o[unit]))
    found = found.select(*KEY, others.alias("others"), F.explode("owners").alias("a"))
    if pairs is not None:
        wanted: dict[str, list[str]] = {}
        for a, b in pairs:
            wanted.setdefault(a, []).append(b)
        found = found.where(F.col(f"a.{unit}").isin(*wanted))
        of = F.coalesce(*[F.when(F.col(f"a.{unit}") == a, F.array(*map(F.lit, bs))) for a, bs in wanted.items()], F.array().cast("array<string>"))
        found = found.withColumn("others", F.array_intersect("others", of))
    return found.select(*KEY, *_side("a", "a", unit, *columns), F.explode("others").alias(f"{unit}_b"))


def shared_detail(by_repertoire: DataFrame) -> DataFrame:
    """Ordered pairs of repertoires with a junction in common, with both sides' counts."""
    return _compared(by_repertoire, "repertoire_id", "sequence_count", "duplicate_count")


def _all(ids: list[str]) -> Column:
    return F.array(*map(F.lit, ids)).cast("array<string>")


def diff_detail(by_repertoire: DataFrame, keep_absent_genes: bool = False, units: DataFrame | None = None, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """Junctions of A that B doesn't have, for ordered pairs, or for ``pairs`` alone. ``units``: the repertoires
    that are compared (those with a junction, where none are given).

    At levels with genes a gene that B lacks altogether is passed over unless ``keep_absent_genes``."""
    found = written(owners(by_repertoire, "repertoire_id", "sequence_count", "duplicate_count"), "share-owners")
    ids = unit_ids(found.select(F.explode("owners.repertoire_id").alias("repertoire_id")) if units is None else units, "repertoire_id")
    candidates = _all(ids)
    if not keep_absent_genes:
        genes = found.where("gene_key <> ''").select("level", "gene_key", F.explode("owners.repertoire_id").alias("id")).groupBy("level", "gene_key").agg(F.collect_set("id").alias("having"))
        found = found.join(genes, ["level", "gene_key"], "left")
        candidates = F.when(F.col("gene_key") == "", _all(ids)).otherwise(F.array_intersect(_all(ids), F.coalesce("having", _all([]))))
    return _lacking(found, "repertoire_id", candidates, pairs, "sequence_count", "duplicate_count")


def patterns(frame: DataFrame, unit: str, ids: list[str]) -> DataFrame:
    """level, ``present`` (places in ``ids`` of the units that own a junction), n: junctions with these owners.

    A bitmap of a junction's owners is one partial aggregate of bit_or per word; junctions are then counted
    by their bitmap, so what is expanded later grows with the distinct bitmaps."""
    places = frame.sparkSession.createDataFrame(list(zip(ids, range(len(ids)), strict=True)), f"{unit} string, _at int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_at") % WORD)
    words = [f"_w{k}" for k in range(max(1, -(-len(ids) // WORD)))]
    set_bits = [F.bit_or(F.when(F.floor(F.col("_at") / WORD) == k, bit).otherwise(F.lit(0).cast("bigint"))).alias(w) for k, w in enumerate(words)]
    maps = frame.select(*KEY, unit).join(places, unit).groupBy(*KEY).agg(*set_bits)
    counted = maps.groupBy("level", *words).agg(F.count("*").alias("n"))
    held = F.filter(F.sequence(F.lit(0), F.lit(max(len(ids), 1) - 1)), lambda i: F.call_function("shiftright", F.get(F.array(*words), F.floor(i / WORD).cast("int")), i % WORD).bitwiseAND(F.lit(1).cast("bigint")) == 1)
    return written(counted.select("level", held.alias("present"), "n"), "share-patterns")


def _named(place: Column, ids: list[str]) -> Column:
    return F.get(_all(ids), place)


def share_matrix(by_repertoire: DataFrame, units: DataFrame | None = None, levels: tuple[str, ...] | None = None) -> DataFrame:
    """level, repertoire_id_a, repertoire_id_b, n_shared (A and B; the diagonal is A), n_diff (A without B). ``units``: all
    repertoires, also such without junctions; ``levels``: all levels (those that occur, where none are given).

    From counts of distinct bitmaps; the difference is the size of A less what is shared."""
    ids = unit_ids(by_repertoire if units is None else units, "repertoire_id")
    counted = patterns(by_repertoire, "repertoire_id", ids)
    a = counted.select("level", "present", "n", F.explode("present").alias("a"))
    shared = a.select("level", "a", F.explode("present").alias("b"), "n").groupBy("level", "a", "b").agg(F.sum("n").alias("n_shared"))
    spark = by_repertoire.sparkSession
    wanted = counted.select("level").distinct() if levels is None else spark.createDataFrame([(x,) for x in levels if x in SHARE_LEVELS], "level string")
    every = F.sequence(F.lit(0), F.lit(len(ids) - 1)) if ids else F.array().cast("array<int>")
    grid = wanted.select("level", F.explode(every).alias("a")).select("level", "a", F.explode(every).alias("b"))
    filled = grid.join(shared, ["level", "a", "b"], "left").withColumn("n_shared", F.coalesce("n_shared", F.lit(0)))
    size = F.max(F.when(F.col("a") == F.col("b"), F.col("n_shared"))).over(Window.partitionBy("level", "a"))
    return filled.select("level", _named(F.col("a"), ids).alias("repertoire_id_a"), _named(F.col("b"), ids).alias("repertoire_id_b"), "n_shared", (size - F.col("n_shared")).alias("n_diff"))


_GROUP_COUNTS = ("share_level", "sequence_count", "duplicate_count")


def compare_groups(by_group: DataFrame) -> DataFrame:
    """Ordered pairs of groups with a junction in common: both share levels and counts."""
    return _compared(by_group, "repertoire_group_id", *_GROUP_COUNTS)


def compared_totals(by_group: DataFrame) -> DataFrame:
    """level, repertoire_group_id_a, repertoire_group_id_b, n (junctions in common), and both sides' counts over them."""
    sums = [F.sum(f"{c}_{s}").alias(f"{c}_{s}") for c in _GROUP_COUNTS[1:] for s in "ab"]
    return compare_groups(by_group).groupBy("level", "repertoire_group_id_a", "repertoire_group_id_b").agg(F.count("*").alias("n"), *sums)


def diff_groups(by_group: DataFrame, units: DataFrame | None = None, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """Junctions of group A that group B has at no share level, for ordered pairs of groups, or for ``pairs`` alone.
    ``units``: the groups that are compared (those with a junction of the level, where none are given)."""
    found = owners(by_group, "repertoire_group_id", *_GROUP_COUNTS)
    if units is not None:
        return _lacking(found, "repertoire_group_id", _all(unit_ids(units, "repertoire_group_id")), pairs, *_GROUP_COUNTS)
    found = written(found, "share-owners")
    having = found.select("level", F.explode("owners.repertoire_group_id").alias("id")).groupBy("level").agg(F.collect_set("id").alias("having"))
    return _lacking(found.join(having, "level"), "repertoire_group_id", F.col("having"), pairs, *_GROUP_COUNTS)


def by_weight(detail: DataFrame) -> DataFrame:
    """A detail report in its order: side A's duplicate count, largest first, then the keys."""
    keys = [c for c in detail.columns if not c.endswith(("_count_a", "_count_b"))]
    return detail.orderBy(F.desc("duplicate_count_a"), *keys)


def group_matrix(by_repertoire: DataFrame, members: DataFrame) -> DataFrame:
    """Junctions by share level in A and share level in B, with zeros up to each group's largest share level.

    A group's share level is the number of its members in the junction's bitmap; so groups, too, are
    compared on the distinct bitmaps."""
    ids = unit_ids(by_repertoire, "repertoire_id")
    counted = patterns(by_repertoire, "repertoire_id", ids).select("level", "n", F.transform("present", lambda i: _named(i, ids)).alias("present"))
    members = members.select("repertoire_group_id", "repertoire_id").distinct()
    # share levels by pattern: an entry per group and distinct bitmap
    by_pattern = counted.select("level", "present", "n", F.explode("present").alias("repertoire_id")).join(members, "repertoire_id").groupBy("level", "present", "n", "repertoire_group_id").agg(F.count("*").alias("share_level"))
    levels = written(by_pattern.groupBy("level", "present", "n").agg(F.collect_list(F.struct("repertoire_group_id", "share_level")).alias("gs")), "share-levels")
    pairs = levels.select("level", "n", "gs", F.explode("gs").alias("a")).select("level", "n", "a", F.explode("gs").alias("b")).where("a.repertoire_group_id <> b.repertoire_group_id")
    keys = ["level", "repertoire_group_id_a", "repertoire_group_id_b", "share_level_a", "share_level_b"]
    shared = pairs.select("level", *[F.col(f"{s}.{c}").alias(f"{c}_{s}") for c in ("repertoire_group_id", "share_level") for s in "ab"], "n").groupBy(*keys).agg(F.sum("n").alias("n"))
    most = levels.select("level", F.explode("gs").alias("g")).groupBy("level", "g.repertoire_group_id").agg(F.max("g.share_level").alias("most"))
    side = lambda s: most.select("level", F.col("repertoire_group_id").alias(f"repertoire_group_id_{s}"), F.explode(F.sequence(F.lit(1).cast("bigint"), "most")).alias(f"share_level_{s}"))
    grid = side("a").join(side("b"), "level").where("repertoire_group_id_a <> repertoire_group_id_b")
    return grid.join(shared, keys, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def read_shares(earlier: DataFrame, now: DataFrame | None = None) -> DataFrame:
    """The sharing table of an earlier run, with the rows of this one that it doesn't have yet."""
    if now is None:
        return earlier
    return earlier.unionByName(now.join(earlier.select(*KEY, "repertoire_id"), [*KEY, "repertoire_id"], "left_anti"))
