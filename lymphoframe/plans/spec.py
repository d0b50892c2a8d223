"""Calculation specs: named calculations over one set of inputs give named result tables.

A calculation is a plain function of (context, calculation, shared counts) to a dict of DataFrames; ``run``
looks them up by type. What they count in the rows is counted for all of them in one scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lymphoframe.functions.calls import MOST_LABELS, is_productive, resolve, resolve_by_join, weight
from lymphoframe.operators import clones, groups, junction, mutations, segments, sharing
from lymphoframe.plans.shared import Piece, Shared
from lymphoframe.schema import REGIONS, SEGMENTS
from lymphoframe.tables import written


@dataclass
class Calculation:
    type: str
    operations: list[str] = field(default_factory=list)
    levels: list[str] = field(default_factory=list)


@dataclass
class Context:
    """Inputs. ``positions``: the long mutation table; without it mutations are read from the rows' own
    columns. ``repertoires``: the metadata, against which ``selected`` and ``members`` are checked.
    ``selected``: repertoires to compute for (all where it is None); junction calculations keep to the
    whole metadata. ``earlier``: the sharing table of an earlier run, to which this one's is added."""

    rearrangements: DataFrame
    germline: DataFrame | None = None
    members: DataFrame | None = None
    filters: dict[str, dict] = field(default_factory=dict)
    positions: DataFrame | None = None
    order: str = "sequence_id"
    repertoires: DataFrame | None = None
    selected: list[str] | None = None
    earlier: DataFrame | None = None
    _resolved: DataFrame | None = None
    _large: bool | None = None

    def check(self) -> None:
        """Unknown ids are an error before anything is computed; only such ids reach the driver."""
        if self.repertoires is None:
            return
        if self.selected:
            wanted = self.repertoires.sparkSession.createDataFrame([(x,) for x in self.selected], "repertoire_id string")
            unknown = [r[0] for r in wanted.join(self.repertoires, "repertoire_id", "left_anti").take(5)]
            if unknown:
                raise ValueError(f"repertoires that the metadata lacks: {', '.join(unknown)}")
        if self.members is not None:
            missing = groups.missing_members(self.members, self.repertoires).take(5)
            if missing:
                raise ValueError("group members that the metadata lacks: " + ", ".join(f"{r.repertoire_id} ({r.repertoire_group_id})" for r in missing))

    def chosen(self, rows: DataFrame) -> DataFrame:
        """The rows of the selected repertoires."""
        return rows.where(F.col("repertoire_id").isin(self.selected)) if self.selected else rows

    def named(self, rows: DataFrame, segments: tuple[str, ...] = SEGMENTS) -> DataFrame:
        """Rows, or a tally, with their calls resolved: a dictionary of a germline set's size goes to every task, a
        larger one is joined."""
        if self.germline is None:
            raise ValueError("this calculation needs a germline set")
        if self._large is None:
            self._large = self.germline.limit(MOST_LABELS + 1).count() > MOST_LABELS
        return (resolve_by_join if self._large else resolve)(rows, self.germline, segments)

    def all_resolved(self) -> DataFrame:
        if self._resolved is None:
            self._resolved = self.named(self.rearrangements)
        return self._resolved

    def resolved(self) -> DataFrame:
        return self.chosen(self.all_resolved())

    def passed(self, rows: DataFrame) -> DataFrame:
        """Rows with the filtered groups that they pass; without groups, with none."""
        return groups.with_passed(rows, self.filters if self.members is not None else {})

    def regrouped(self, results: DataFrame) -> DataFrame:
        """Group results of what was computed by repertoire and passed groups."""
        if self.members is None:
            raise ValueError("this calculation needs repertoire groups")
        return groups.regrouped(results, self.members, self.filters)

    def grouped(self, rows: DataFrame) -> DataFrame:
        """One row per group of a row, for reports of rows."""
        return self.regrouped(self.passed(rows))


#: Keys of the aggregates that repertoire and group results are both made of.
PASSED = ("repertoire_id", "passed")


def _segment_pieces(calc: Calculation) -> dict[str, Piece]:
    calls = lambda parts: {f"{x}_call": F.col(f"{x}_call") for x in parts}
    out = {}
    if "usage" in calc.operations:  # each segment's call on its own
        apart = lambda s: {c: F.coalesce(x, F.lit("")) if c == f"{s}_call" else F.lit(None) for c, x in calls(SEGMENTS).items()}
        out["usage"] = Piece([apart(s) for s in SEGMENTS])
    if "combo" in calc.operations:
        out |= {f"{c}_combo": Piece([calls(parts)]) for c, parts in segments.COMBOS.items()}
    return out


def gene_segment(ctx: Context, calc: Calculation, shared: Shared) -> dict[str, DataFrame]:
    """Everything is made of the tallies of distinct calls by repertoire and passed groups."""
    out = {}
    both = ("repertoire_group_id", "repertoire_id")
    for name in _segment_pieces(calc):
        if name == "usage":
            kind, parts, count = "field", SEGMENTS, (lambda r, by: segments.usage(r, by, totals=True))
        else:
            kind, combo = "combo", name.removesuffix("_combo")
            parts, count = segments.COMBOS[combo], (lambda r, by, combo=combo: segments.combos(r, combo, by, totals=True))
        tally = shared.table(name)
        out[name] = segments.with_frequency(count(ctx.named(tally, parts), ("repertoire_id",)), ["repertoire_id", kind])
        if ctx.members is not None:
            members = segments.with_frequency(count(ctx.named(ctx.regrouped(tally), parts), both), [*both, kind])
            out[f"{name}_group_repertoires"] = members
            out[f"{name}_groups"] = groups.group_mean_std(members, ctx.members, [kind, "level", "mode", "productive", "name"], ["sequence_count", "sequence_frequency", "duplicate_count", "duplicate_frequency"])
    return out


def _lengths(ctx: Context, histogram: DataFrame, name: str) -> dict[str, DataFrame]:
    """Dense tables with shares, by repertoire, by group and by a group's members, of a histogram by repertoire and passed groups."""
    def table(counts: DataFrame, *by: str) -> DataFrame:
        keys = [*by, "productive"]
        return junction.relative(junction.dense(counts.groupBy(*keys, "length").agg(F.sum("count").alias("count")), keys), keys)

    out = {name: table(histogram, "repertoire_id")}
    if ctx.members is not None:
        grouped = ctx.regrouped(histogram)
        out[f"{name}_groups"], out[f"{name}_group_repertoires"] = table(grouped, "repertoire_group_id"), table(grouped, "repertoire_group_id", "repertoire_id")
    return out


def _cdr3_pieces(calc: Calculation) -> dict[str, Piece]:
    out = {}
    filled = "length" in calc.operations  # a computed length is there for the groups' filters, also of the letters
    if filled:
        out["length"] = Piece([{f"length_{kind}": junction.length_column(kind) for kind in ("aa", "nt")}], filled=True, every=True)
    if "distribution" in calc.operations:
        out["letters_filled" if filled else "letters"] = Piece([{"junction_aa": F.col("junction_aa"), "junction": F.col("junction")}], filled=filled, every=True)
    if {"shared", "compare"} & set(calc.operations):
        for level in calc.levels:
            if level in sharing.SHARE_LEVELS:
                key = sharing.share_key(level)
                sound = F.coalesce(is_productive() & (key["cdr3"] != "") & key["gene_key"].isNotNull(), F.lit(False))
                out[f"share {level}"] = Piece([key], where=sound, groups=False, every=True)
    return out


def _shares(calc: Calculation, shared: Shared, ctx: Context) -> DataFrame:
    """The sharing table from its pieces."""
    out = None
    for level in dict.fromkeys(x for x in calc.levels if x in sharing.SHARE_LEVELS):
        one = shared.table(f"share {level}").select(F.lit(level).alias("level"), "gene_key", "cdr3", "repertoire_id", F.col("rows").alias("sequence_count"), F.col("weights").alias("duplicate_count"))
        out = one if out is None else out.unionByName(one)
    return out if out is not None else ctx.rearrangements.sparkSession.createDataFrame([], "level string, gene_key string, cdr3 string, repertoire_id string, sequence_count long, duplicate_count long")


def cdr3(ctx: Context, calc: Calculation, shared: Shared) -> dict[str, DataFrame]:
    out: dict[str, DataFrame] = {}
    for kind in ("aa", "nt"):
        if "length" in calc.operations:
            for tail, weighted in (("", True), ("_wo_duplicates", False)):
                out |= _lengths(ctx, junction.lengths_of(shared.table("length"), kind, PASSED, weighted), f"length_{kind}{tail}")
        if "distribution" in calc.operations:
            letters = junction.distribution(shared.table("letters_filled" if "length" in calc.operations else "letters"), kind, PASSED)
            total = lambda counts, by: counts.groupBy(by, "productive", "length", "position", "letter").agg(F.sum("count").alias("count"))
            out[f"distribution_{kind}"] = total(letters, "repertoire_id")
            if ctx.members is not None:
                out[f"distribution_{kind}_groups"] = total(ctx.regrouped(letters), "repertoire_group_id")
    if {"shared", "compare"} & set(calc.operations):
        ctx.all_resolved()  # junction levels with genes need a germline set
        found = _shares(calc, shared, ctx)
        if ctx.earlier is not None:
            found = written(sharing.read_shares(ctx.earlier, found), "shares")
        by_group = sharing.group_shares(found, ctx.members) if ctx.members is not None else None
        if "shared" in calc.operations:
            out["share_repertoires"] = found
            out["share_repertoire_summary"] = found.groupBy("level", "repertoire_id").agg(F.count("*").alias("n"))
            if by_group is not None:
                out["share_group_detail"], out["share_summary"] = sharing.group_detail(found, ctx.members), sharing.share_summary(by_group)
        if "compare" in calc.operations:
            out["share_matrix"], out["share_detail"], out["share_diff"] = sharing.share_matrix(found, ctx.repertoires, tuple(calc.levels)), sharing.shared_detail(found), sharing.diff_detail(found, units=ctx.repertoires)
            if by_group is not None:
                out["group_matrix"], out["group_detail"], out["group_diff"] = sharing.group_matrix(found, ctx.members), sharing.by_weight(sharing.compare_groups(by_group)), sharing.by_weight(sharing.diff_groups(by_group, ctx.members))
    return out


def filters(ctx: Context, calc: Calculation, shared: Shared) -> dict[str, DataFrame]:
    return {"filtered": ctx.grouped(ctx.resolved() if ctx.germline is not None else ctx.chosen(ctx.rearrangements)).select("repertoire_group_id", *ctx.rearrangements.columns)}


def _clone_pieces(calc: Calculation) -> dict[str, Piece]:
    return {f"clones {level}": Piece([clones.clone_key(level)], where=clones.takes_part(), groups=False, ordered=True) for level in calc.levels or ["allele", "gene"]}


def clonal_assignment(ctx: Context, calc: Calculation, shared: Shared) -> dict[str, DataFrame]:
    rows, out = ctx.resolved(), {}
    for level in calc.levels or ["allele", "gene"]:
        summed = shared.table(f"clones {level}").select(*clones.KEY, F.col("rows").alias("clone_count"), F.col("last_weight").alias("duplicate_count"), "first_ord")
        found = clones.numbered(summed)  # written: what follows doesn't count again
        out[f"clones_{level}"], out[f"clone_rows_{level}"], out[f"clones_{level}_merged"] = found, clones.assign(rows, found, level), clones.merge(summed)
    return out


def _summed(ctx: Context, rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Sums by position; the rows' own columns are packed with keys and weight beside them."""
    if ctx.positions is not None:
        return mutations.weighted(ctx.positions, rows, by)
    return mutations.summed_vectors(mutations.from_rows(rows.withColumn("w", weight()), *by, "w"), by)


def mutation(ctx: Context, calc: Calculation, shared: Shared) -> dict[str, DataFrame]:
    rows, out = ctx.resolved(), {}
    for level in calc.levels or ["repertoire"]:
        if level == "rearrangement":
            own = ctx.chosen(ctx.rearrangements)
            columns = [c for c in own.columns if not c.startswith("mu_")]
            if ctx.positions is not None:
                out["mutation_rows"] = mutations.mutation_rows(own.select(*columns), own.select("sequence_id", *REGIONS), ctx.positions)
            else:
                columns.remove("sequence_id")
                out["mutation_rows"] = mutations.mutation_vector_rows(mutations.from_rows(own, *columns), *columns)
            continue
        if level == "repertoire_group":
            by, keyed = ("repertoire_group_id", "repertoire_id"), ctx.passed(rows)
            sums = ctx.regrouped(_summed(ctx, keyed, PASSED))
            by_position = sums.groupBy(*by, "pos", "region", "region_class").agg(*[F.sum(c).alias(c) for c in mutations.SUMS])
            totals = ctx.regrouped(mutations.sequence_totals(keyed, PASSED)).groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("mu_seq_count", "mu_duplicate_count")])
        else:
            key = {"repertoire": "repertoire_id", "clone": "clone_id"}.get(level, level)
            by = {"repertoire_id": ("repertoire_id",), "clone_id": ("repertoire_id", "clone_id")}.get(key, ("repertoire_id", "segment"))
            keyed = mutations.keyed_rows(rows, key)
            by_position, totals = _summed(ctx, keyed, by), mutations.sequence_totals(keyed, by)
        by_position = written(by_position, f"mutations-{level}")
        rolled = written(mutations.rolled_up(by_position, by), f"mutations-{level}-rolled")
        if "count" in calc.operations:
            out[f"mutation_counts_{level}"] = rolled
            out[f"mutation_count_report_{level}"] = mutations.wide_counts(rolled, by, totals, mutations.unique_positions(by_position, by))
        if "frequency" in calc.operations:
            frequency, ratios = mutations.frequencies(rolled, by), mutations.region_ratios(rolled, by)
            out[f"mutation_frequencies_{level}"], out[f"mutation_ratios_{level}"] = frequency, ratios
            out[f"mutation_frequency_report_{level}"] = mutations.wide_frequencies(frequency, ratios, by)
            if level == "repertoire_group":
                out["mutation_group_frequencies"], out["mutation_group_ratios"] = mutations.group_frequencies(rolled), mutations.group_ratios(ratios)
                out["mutation_group_report"] = mutations.wide_group_frequencies(rolled)
    return out


CALCULATIONS: dict[str, Callable[[Context, Calculation, Shared], dict[str, DataFrame]]] = {
    "gene_segment": gene_segment, "CDR3": cdr3, "filters": filters, "clonal_assignment": clonal_assignment, "mutations": mutation,
}
#: What calculations count in the one scan that they share.
PIECES: dict[str, Callable[[Calculation], dict[str, Piece]]] = {"gene_segment": _segment_pieces, "CDR3": _cdr3_pieces, "clonal_assignment": _clone_pieces}


def run(ctx: Context, calculations: list[Calculation | dict]) -> dict[str, DataFrame]:
    """Result tables by name. An unknown type, repertoire or member is an error before anything is computed.

    All calculations count in one scan of the rows (``shared``); mutations, whose sums are vectors, have one of their own."""
    calcs = [Calculation(**c) if isinstance(c, dict) else c for c in calculations]
    for c in calcs:
        if c.type not in CALCULATIONS:
            raise ValueError(f"no such calculation: {c.type}")
        if c.type in ("gene_segment", "clonal_assignment", "mutations"):
            ctx.all_resolved()
    ctx.check()
    shared = Shared(ctx.all_resolved() if ctx.germline is not None else ctx.rearrangements, ctx.filters if ctx.members is not None else {}, ctx.selected, ctx.order)
    for c in calcs:
        for tag, piece in PIECES.get(c.type, lambda _: {})(c).items():
            shared.add(tag, piece)
    out: dict[str, DataFrame] = {}
    for c in calcs:
        out.update(CALCULATIONS[c.type](ctx, c, shared))
    return out
