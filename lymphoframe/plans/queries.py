"""The registered queries: each applies one operator to the fixture views of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lymphoframe.functions.calls import resolve, weight
from lymphoframe.functions.predicates import predicate
from lymphoframe.operators import clones as clone_ops
from lymphoframe.operators import groups as group_ops
from lymphoframe.operators import junction as junction_ops
from lymphoframe.operators import mutations as mutation_ops
from lymphoframe.operators import segments as segment_ops
from lymphoframe.operators import sharing as share_ops
from lymphoframe.schema import REGIONS
from lymphoframe.sources.fixtures import mutation_lengths, mutation_sums, mutation_translations, mutation_vectors, views
from lymphoframe.tables import written

#: Filters of the fixture groups (groups without one take all rows).
FILTERS = {
    "g_len12": {"op": "=", "content": {"field": "junction_aa_length", "value": 12}},
    "g_long": {"op": ">", "content": {"field": "junction_aa_length", "value": 15}},
    "g_v4": {"op": "=", "content": {"field": "v_subgroup", "value": "IGHV4"}},
    "g_v4_j6": {"op": "AND", "content": [{"op": "=", "content": {"field": "v_subgroup", "value": "IGHV4"}}, {"op": "=", "content": {"field": "j_subgroup", "value": "IGHJ6"}}]},
    "g_v3_or_v4": {"op": "or", "content": [{"op": "=", "content": {"field": "v_subgroup", "value": "IGHV3"}}, {"op": "=", "content": {"field": "v_subgroup", "value": "IGHV4"}}]},
}
#: Repertoires that the selection queries ask for.
SELECTED = ("rep1", "rep3", "rep5")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[name] = f
        return f

    return put


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, germline = views(spark, sf_dir, "rearrangements", "germline")
    return resolve(rows, germline)


def _tallied(spark: SparkSession, sf_dir: str, segments: tuple[str, ...], apart: bool) -> DataFrame:
    """Rows by their distinct calls, resolved: calls are counted first and named afterwards."""
    rows, germline = views(spark, sf_dir, "rearrangements", "germline")
    return resolve(segment_ops.tally(rows, segments=segments, apart=apart), germline, segments)


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views(spark, sf_dir, "group_members")[0]


def _passed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with the filtered groups that they pass; no call is named for it."""
    rows, germline = views(spark, sf_dir, "rearrangements", "germline")
    return group_ops.with_passed(rows, FILTERS, germline)


def _measured_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``_passed_rows``, for lengths: a missing length is filled in before the groups' filters see the row."""
    rows, germline = views(spark, sf_dir, "rearrangements", "germline")
    return group_ops.with_passed(junction_ops.with_length(rows), FILTERS, germline)


_PASSED = ("repertoire_id", "passed")


def _regrouped(results: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_ops.regrouped(results, _members(spark, sf_dir), FILTERS)


def _group_tally(spark: SparkSession, sf_dir: str, segments: tuple[str, ...], apart: bool) -> DataFrame:
    """The tally of each group's members: rows are counted by call once, groups are made of the counts."""
    tally = _regrouped(segment_ops.tally(_passed_rows(spark, sf_dir), _PASSED, segments, apart), spark, sf_dir)
    return resolve(tally, views(spark, sf_dir, "germline")[0], segments)


# -- germline and groups -------------------------------------------------------------------------


@query("germline_resolve")
def germline_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [F.array_join(f"{s}_{level}", ",").alias(f"{s}_{level}") for s in ("v", "j") for level in ("allele", "gene", "subgroup")]
    return _resolved(spark, sf_dir).select("sequence_id", *names)


@query("group_membership")
def group_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, members = views(spark, sf_dir, "rearrangements", "group_members")
    return rows.join(members, "repertoire_id").groupBy("repertoire_group_id", "repertoire_id").agg(F.count("*").alias("n"))


@query("group_missing_members")
def group_missing_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, members = views(spark, sf_dir, "rearrangements", "nation_members")
    return group_ops.missing_members(members, rows.select("repertoire_id").distinct())


# -- filters -------------------------------------------------------------------------------------


@query("filter_repertoire_selection")
def filter_repertoire_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, members = views(spark, sf_dir, "rearrangements", "group_members")
    return group_ops.select_repertoires(rows, members.where(F.col("repertoire_id").isin(*SELECTED))).select("sequence_id", "repertoire_id", "productive")


@query("filter_group_rows")
def filter_group_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regrouped(_passed_rows(spark, sf_dir).select("repertoire_id", "passed", "sequence_id"), spark, sf_dir).select("repertoire_group_id", "repertoire_id", "sequence_id")


def _filtered(spec: dict) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = _resolved(spark, sf_dir)
        return rows.where(predicate(spec, rows)).select("sequence_id", "repertoire_id")

    return run


def _leaf(op: str, field: str, value) -> dict:
    return {"op": op, "content": {"field": field, "value": value}}


LEAVES = {
    "filter_eq_scalar": _leaf("=", "junction_aa_length", 12),
    "filter_eq_derived_list": _leaf("=", "v_gene", "IGHV3-2"),
    "filter_ne": _leaf("!=", "duplicate_count", 7),
    "filter_ne_derived_list": _leaf("!=", "j_subgroup", "IGHJ2"),
    "filter_range": {"op": "AND", "content": [_leaf(">=", "duplicate_count", 10), _leaf("<", "junction_aa_length", 9)]},
    "filter_contains": _leaf("contains", "junction_aa", "CAS"),
    "filter_contains_list": _leaf("contains", "v_subgroup", "TRBV3"),
    "filter_and": FILTERS["g_v4_j6"],
    "filter_or": FILTERS["g_v3_or_v4"],
    "filter_nested": {"op": "or", "content": [FILTERS["g_v4_j6"], _leaf(">", "junction_aa_length", 18), _leaf("?", "locus", "IGH")]},
}
for _name, _spec in LEAVES.items():
    QUERIES[_name] = _filtered(_spec)


@query("clone_input_filter")
def clone_input_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clone_ops.clone_input(views(spark, sf_dir, "rearrangements")[0].withColumn("locus", F.when(F.col("locus") == "TRB", "TRB").otherwise(F.col("locus")))).select("sequence_id", "repertoire_id", "junction_aa")


# -- segment usage -------------------------------------------------------------------------------


def _usage(mode: str | None = None, segments=("v", "d", "j", "c"), frequency: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = segment_ops.usage(_tallied(spark, sf_dir, tuple(segments), True), segments=segments, totals=frequency)
        if mode:
            out = out.where(F.col("mode") == mode)
        return segment_ops.with_frequency(out, ["repertoire_id", "field"]) if frequency else out

    return run


QUERIES["usage_unique"] = _usage("unique", ("v",))
QUERIES["usage_exists"] = _usage("exists", ("v",), True)
QUERIES["usage_proportion"] = _usage("proportion", ("v",))
QUERIES["usage_levels"] = _usage(None, ("j",))
QUERIES["usage_fields"] = _usage(None)
QUERIES["usage_frequency"] = _usage(None, frequency=True)


def _combo(combo: str, frequency: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = segment_ops.combos(_tallied(spark, sf_dir, segment_ops.COMBOS[combo], False), combo, totals=frequency)
        return segment_ops.with_frequency(out, ["repertoire_id", "combo"]) if frequency else out

    return run


for _name in segment_ops.COMBOS:
    QUERIES[f"combo_{_name}"] = _combo(_name)
QUERIES["combo_frequency"] = _combo("vj", True)


@query("group_usage_pooled")
def group_usage_pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_ops.usage(_group_tally(spark, sf_dir, ("v", "j"), True), ("repertoire_group_id",), ("v", "j"))


@query("group_repertoire_usage")
def group_repertoire_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_ops.usage(_group_tally(spark, sf_dir, ("v",), True), ("repertoire_group_id", "repertoire_id"), ("v",))


_STATS = ["sequence_count", "sequence_frequency", "duplicate_count", "duplicate_frequency"]


@query("group_usage_stats")
def group_usage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_member = segment_ops.with_frequency(segment_ops.usage(_group_tally(spark, sf_dir, ("v",), True), ("repertoire_group_id", "repertoire_id"), ("v",), totals=True), ["repertoire_group_id", "repertoire_id", "field"])
    return group_ops.group_mean_std(by_member, _members(spark, sf_dir), ["field", "level", "mode", "productive", "name"], _STATS)


@query("group_combo_stats")
def group_combo_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_member = segment_ops.with_frequency(segment_ops.combos(_group_tally(spark, sf_dir, ("v", "j"), False), "vj", ("repertoire_group_id", "repertoire_id"), ("subgroup",), totals=True), ["repertoire_group_id", "repertoire_id", "combo"])
    return group_ops.group_mean_std(by_member, _members(spark, sf_dir), ["combo", "level", "mode", "productive", "name"], _STATS)


# -- junction lengths and letters ----------------------------------------------------------------


def _lengths(kind: str, weighted: bool = True) -> Query:
    return lambda spark, sf_dir: junction_ops.lengths(views(spark, sf_dir, "rearrangements")[0], kind, weighted=weighted)


QUERIES["length_aa"] = _lengths("aa")
QUERIES["length_nt"] = _lengths("nt")
QUERIES["length_aa_wo_dup"] = _lengths("aa", False)
QUERIES["length_nt_wo_dup"] = _lengths("nt", False)


@query("length_dense")
def length_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return junction_ops.dense(junction_ops.lengths(views(spark, sf_dir, "rearrangements")[0], "aa"), ["repertoire_id", "productive"])


@query("length_relative")
def length_relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return junction_ops.relative(junction_ops.lengths(views(spark, sf_dir, "rearrangements")[0], "aa"), ["repertoire_id", "productive"])


@query("length_table_stats")
def length_table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return junction_ops.length_stats(junction_ops.lengths(views(spark, sf_dir, "rearrangements")[0], "aa"), ["repertoire_id", "productive"])


def _group_lengths(spark: SparkSession, sf_dir: str, *by: str) -> DataFrame:
    found = _regrouped(junction_ops.lengths(_measured_rows(spark, sf_dir), "aa", _PASSED), spark, sf_dir)
    return found.groupBy(*by, "productive", "length").agg(F.sum("count").alias("count"))


QUERIES["group_length"] = lambda spark, sf_dir: _group_lengths(spark, sf_dir, "repertoire_group_id")


@query("group_length_stats")
def group_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_member = _group_lengths(spark, sf_dir, "repertoire_group_id", "repertoire_id")
    return group_ops.group_mean_std(by_member, _members(spark, sf_dir), ["productive", "length"], ["count"])


def _distribution(kind: str) -> Query:
    return lambda spark, sf_dir: junction_ops.distribution(views(spark, sf_dir, "rearrangements")[0], kind)


QUERIES["distribution_aa"] = _distribution("aa")
QUERIES["distribution_nt"] = _distribution("nt")


@query("distribution_relative")
def distribution_relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = junction_ops.distribution(views(spark, sf_dir, "rearrangements")[0], "nt")
    return junction_ops.relative_distribution(counts, ["repertoire_id", "productive"])


def _group_letters(spark: SparkSession, sf_dir: str, kind: str, *by: str) -> DataFrame:
    found = _regrouped(junction_ops.distribution(_passed_rows(spark, sf_dir), kind, _PASSED), spark, sf_dir)
    return found.groupBy(*by, "productive", "length", "position", "letter").agg(F.sum("count").alias("count"))


QUERIES["group_distribution_aa"] = lambda spark, sf_dir: _group_letters(spark, sf_dir, "aa", "repertoire_group_id")


@query("group_distribution_stats")
def group_distribution_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_member = _group_letters(spark, sf_dir, "nt", "repertoire_group_id", "repertoire_id").withColumn("count", F.col("count").cast("double"))
    return group_ops.group_mean_std(by_member, _members(spark, sf_dir), ["productive", "length", "position", "letter"], ["count"])


# -- sharing -------------------------------------------------------------------------------------


def _shares(*levels: str) -> Query:
    return lambda spark, sf_dir: share_ops.shares(_resolved(spark, sf_dir), levels)


for _name, _level in (("aa", "aa"), ("nt", "nucleotide"), ("v_aa", "v,aa"), ("v_nt", "v,nucleotide"), ("vj_aa", "vj,aa"), ("vj_nt", "vj,nucleotide")):
    QUERIES[f"share_rep_{_name}"] = _shares(_level)


def _group_shares(*levels: str) -> Query:
    return lambda spark, sf_dir: share_ops.group_shares(share_ops.shares(_resolved(spark, sf_dir), levels), _members(spark, sf_dir))


QUERIES["share_group_aa"] = _group_shares("aa")
QUERIES["share_level_detail"] = _group_shares("v,aa")
QUERIES["share_summary_group"] = lambda spark, sf_dir: share_ops.share_summary(_group_shares("aa", "vj,aa")(spark, sf_dir))
QUERIES["share_summary_rep"] = lambda spark, sf_dir: _shares("aa", "vj,aa")(spark, sf_dir).groupBy("level", "repertoire_id").agg(F.count("*").alias("n"))


@query("share_group_detail")
def share_group_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = share_ops.group_detail(_shares("aa")(spark, sf_dir), _members(spark, sf_dir))
    text = F.array_join(F.transform("repertoires", lambda x: F.concat_ws(":", x["repertoire_id"], x["sequence_count"], x["duplicate_count"])), ",")
    return detail.select("repertoire_group_id", "cdr3", text.alias("repertoires"))


def _matrix(level: str, dropped: str) -> Query:
    """All repertoires of the metadata (here those of ``nation_members``) are compared, also such without junctions."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return share_ops.share_matrix(_shares(level)(spark, sf_dir), views(spark, sf_dir, "nation_members")[0], (level,)).drop(dropped)

    return run


#: Pairs of repertoires that a difference is asked for; the last one has no junctions.
PAIRS = [("rep0", "rep1"), ("rep1", "rep0"), ("rep2", "rep5"), ("rep3", "rep20"), ("rep20", "rep3")]

QUERIES["share_matrix_shared"] = _matrix("aa", "n_diff")
QUERIES["share_matrix_shared_v"] = _matrix("v,aa", "n_diff")
QUERIES["share_matrix_diff"] = _matrix("aa", "n_shared")
QUERIES["share_detail_shared"] = lambda spark, sf_dir: share_ops.shared_detail(_shares("vj,aa")(spark, sf_dir))
QUERIES["share_detail_diff"] = lambda spark, sf_dir: share_ops.diff_detail(_shares("v,aa")(spark, sf_dir))
QUERIES["share_detail_diff_pairs"] = lambda spark, sf_dir: share_ops.diff_detail(_shares("aa")(spark, sf_dir), units=views(spark, sf_dir, "nation_members")[0], pairs=PAIRS)
QUERIES["group_share_compare"] = lambda spark, sf_dir: share_ops.compare_groups(_group_shares("aa")(spark, sf_dir))
QUERIES["group_share_diff"] = lambda spark, sf_dir: share_ops.diff_groups(_group_shares("aa")(spark, sf_dir))
QUERIES["group_share_compare_gene"] = lambda spark, sf_dir: share_ops.compare_groups(_group_shares("v,aa")(spark, sf_dir))
QUERIES["group_share_compare_totals"] = lambda spark, sf_dir: share_ops.compared_totals(_group_shares("aa", "v,aa", "vj,nucleotide")(spark, sf_dir))
QUERIES["group_share_diff_gene"] = lambda spark, sf_dir: share_ops.diff_groups(_group_shares("v,aa")(spark, sf_dir))
QUERIES["group_share_matrix"] = lambda spark, sf_dir: share_ops.group_matrix(_shares("aa")(spark, sf_dir), _members(spark, sf_dir))


@query("group_share_diff_absent")
def group_share_diff_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of which some have no member with rows: the whole of the others differs from them."""
    members = views(spark, sf_dir, "nation_members")[0]
    by_group = share_ops.group_shares(_shares("aa")(spark, sf_dir), members)
    return share_ops.diff_groups(by_group, members).groupBy("level", "repertoire_group_id_a", "repertoire_group_id_b", "share_level_a").agg(F.count("*").alias("n"), F.sum("duplicate_count_a").alias("duplicate_count_a"))


def _junctions(spark: SparkSession, sf_dir: str, repertoire: str) -> DataFrame:
    return _shares("aa")(spark, sf_dir).where(F.col("repertoire_id") == repertoire).select("cdr3")


QUERIES["share_set_intersect"] = lambda spark, sf_dir: _junctions(spark, sf_dir, "rep0").intersect(_junctions(spark, sf_dir, "rep1"))
QUERIES["share_set_except"] = lambda spark, sf_dir: _junctions(spark, sf_dir, "rep0").subtract(_junctions(spark, sf_dir, "rep1"))


# -- clones --------------------------------------------------------------------------------------


def _clones(level: str, dup_mode: str = "last") -> Query:
    return lambda spark, sf_dir: clone_ops.clones(_resolved(spark, sf_dir), level, dup_mode=dup_mode)


def _summed_clones(level: str, dup_mode: str = "last") -> Query:
    return lambda spark, sf_dir: clone_ops.summed_clones(_resolved(spark, sf_dir), level, dup_mode=dup_mode)


QUERIES["clone_allele"] = lambda spark, sf_dir: _summed_clones("allele")(spark, sf_dir).drop("first_ord")
QUERIES["clone_gene"] = lambda spark, sf_dir: _summed_clones("gene")(spark, sf_dir).drop("first_ord")
QUERIES["clone_allele_sum"] = lambda spark, sf_dir: _summed_clones("allele", "sum")(spark, sf_dir).drop("first_ord")
QUERIES["clone_ids"] = _clones("gene")


@query("clone_assign_rows")
def clone_assign_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _resolved(spark, sf_dir)
    return clone_ops.assign(rows, clone_ops.clones(rows, "allele"), "allele").select("sequence_id", "repertoire_id", "clone_id")


QUERIES["clone_collapse"] = lambda spark, sf_dir: clone_ops.merge(_summed_clones("allele")(spark, sf_dir))


# -- mutations -----------------------------------------------------------------------------------


def _vectors(spark: SparkSession, sf_dir: str, *carried: str) -> DataFrame:
    return mutation_vectors(spark, views(spark, sf_dir, "rearrangements")[0], *carried)


QUERIES["mutation_region_lengths"] = lambda spark, sf_dir: mutation_lengths(views(spark, sf_dir, "rearrangements")[0])
QUERIES["mutation_translate"] = lambda spark, sf_dir: mutation_translations(views(spark, sf_dir, "rearrangements")[0])
QUERIES["mutation_row_counts"] = lambda spark, sf_dir: mutation_ops.row_vector_counts(_vectors(spark, sf_dir))
QUERIES["mutation_row_region_counts"] = lambda spark, sf_dir: mutation_ops.row_region_vector_counts(_vectors(spark, sf_dir))


QUERIES["mutation_rows"] = lambda spark, sf_dir: mutation_ops.mutation_vector_rows(_vectors(spark, sf_dir, "repertoire_id", "v_call", *REGIONS), "repertoire_id", "v_call")


def _summed(rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Each row's vectors are summed under its keys, with its weight."""
    return mutation_sums(rows.withColumn("w", weight()), by)


def _weighted(key: str) -> tuple[Query, tuple[str, ...]]:
    by = ("repertoire_id",) if key == "repertoire_id" else ("repertoire_id", "clone_id") if key == "clone_id" else ("repertoire_id", "segment")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows, germline = views(spark, sf_dir, "rearrangements", "germline")
        if by[-1] != "segment":
            return _summed(mutation_ops.keyed_rows(rows, key), by)
        sums = _summed(rows, ("repertoire_id", f"{key[0]}_call"))  # distinct calls are named, not rows
        return mutation_ops.added(mutation_ops.keyed_rows(resolve(sums, germline, (key[0],)), key), by)

    return run, by


def _rolled(key: str) -> Query:
    run, by = _weighted(key)
    return lambda spark, sf_dir: mutation_ops.rolled_up(run(spark, sf_dir), by)


_BY_POSITION, _REP = _weighted("repertoire_id")
QUERIES["mutation_pos_counts"] = _BY_POSITION
QUERIES["mutation_rep_counts"] = _rolled("repertoire_id")
QUERIES["mutation_totals"] = lambda spark, sf_dir: mutation_ops.rolled_up(_summed(views(spark, sf_dir, "rearrangements")[0], ()), ()).select("scope", "part", "total", "total_aa")
QUERIES["mutation_region_counts"] = lambda spark, sf_dir: _rolled("repertoire_id")(spark, sf_dir).where("scope = 'region'")
QUERIES["mutation_clone_counts"] = lambda spark, sf_dir: _rolled("clone_id")(spark, sf_dir).where("scope <> 'position'")
for _segment in ("v", "j"):
    for _name in ("call", "gene", "subgroup"):
        QUERIES[f"mutation_{_segment}_{_name}_counts"] = (lambda run: lambda spark, sf_dir: run(spark, sf_dir).where("scope <> 'position'"))(_rolled(f"{_segment}_{_name}"))


_MEMBER = ("repertoire_group_id", "repertoire_id")


def _group_rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The members' roll-ups over the rows that pass their group's filter, written: rows are summed once by
    repertoire and passed groups, and groups are made of these sums."""
    sums = _regrouped(_summed(_passed_rows(spark, sf_dir), _PASSED), spark, sf_dir)
    return written(mutation_ops.rolled_up(sums, _MEMBER), "mutation-members")


QUERIES["mutation_group_rep_counts"] = lambda spark, sf_dir: _group_rolled(spark, sf_dir).where("scope <> 'position'")


@query("mutation_sequence_totals")
def mutation_sequence_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, regions = views(spark, sf_dir, "rearrangements", "regions")
    return mutation_ops.sequence_totals(rows.join(regions.select("sequence_id"), "sequence_id"), ("repertoire_id",))


QUERIES["mutation_unique_positions"] = lambda spark, sf_dir: mutation_ops.unique_positions(_BY_POSITION(spark, sf_dir), _REP)


def _frequencies(scope: str) -> Query:
    return lambda spark, sf_dir: mutation_ops.frequencies(_rolled("repertoire_id")(spark, sf_dir), _REP).where(F.col("scope") == scope)


QUERIES["mutation_freq_global"] = _frequencies("global")
QUERIES["mutation_freq_region"] = lambda spark, sf_dir: mutation_ops.frequencies(_rolled("repertoire_id")(spark, sf_dir), _REP).where("scope in ('region', 'class')")
QUERIES["mutation_freq_pos"] = _frequencies("position")
QUERIES["mutation_region_ratio"] = lambda spark, sf_dir: mutation_ops.region_ratios(_rolled("repertoire_id")(spark, sf_dir), _REP).drop("rsratio", "rsratio_aa")
QUERIES["mutation_rs_ratio"] = lambda spark, sf_dir: mutation_ops.region_ratios(_rolled("clone_id")(spark, sf_dir), ("repertoire_id", "clone_id")).select("repertoire_id", "clone_id", "region_class", "rsratio", "rsratio_aa")
QUERIES["mutation_group_freq_stats"] = lambda spark, sf_dir: mutation_ops.group_frequencies(_group_rolled(spark, sf_dir))
QUERIES["mutation_group_ratio_stats"] = lambda spark, sf_dir: mutation_ops.group_ratios(mutation_ops.region_ratios(_group_rolled(spark, sf_dir), _MEMBER))
QUERIES["mutation_group_wide"] = lambda spark, sf_dir: mutation_ops.wide_group_frequencies(_group_rolled(spark, sf_dir))
