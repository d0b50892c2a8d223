"""Literal rows with expected results for the rules of the data model, and plan checks."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from lymphoframe.functions.calls import resolve, resolve_by_join
from lymphoframe.functions.codons import codon_table, translate
from lymphoframe.functions.predicates import predicate
from lymphoframe.operators import clones, groups, junction, mutations, segments, sharing
from lymphoframe.plans.queries import QUERIES
from lymphoframe.plans.spec import Calculation, Context, run

ROW = "sequence_id string, repertoire_id string, locus string, productive boolean, duplicate_count long, v_call string, d_call string, j_call string, c_call string, junction string, junction_aa string, junction_length long, junction_aa_length long, clone_id string"


def rows(spark, *values):
    base = {"sequence_id": "s", "repertoire_id": "r", "locus": "TRB", "productive": True, "duplicate_count": None, "v_call": "", "d_call": "", "j_call": "", "c_call": "", "junction": "", "junction_aa": "", "junction_length": None, "junction_aa_length": None, "clone_id": None}
    full = [{**base, "sequence_id": f"s{k}", **v} for k, v in enumerate(values)]
    return spark.createDataFrame([tuple(f[n.split()[0]] for n in ROW.split(", ")) for f in full], ROW)


@pytest.fixture(scope="module")
def germline(spark):
    alleles = [("A*01", "", "", "A", None), ("A*02", "", "", "A", None), ("B*01", "", "", "B", "S"), ("J1*01", "", "", "J1", None)]
    return spark.createDataFrame(alleles, "label string, locus string, sequence_type string, gene_designation string, subgroup_designation string")


def test_usage_modes(spark, germline):
    data = resolve(rows(spark, {"v_call": "A*01,A*02", "duplicate_count": 4}, {"v_call": "A*01,B*01,Z*09"}, {"v_call": ""}, {"v_call": None}), germline)
    out = segments.usage(data, segments=("v",)).where("level = 'gene' and not productive")
    got = {(r.mode, r.name): (r.sequence_count, r.duplicate_count) for r in out.collect()}
    assert got == {("unique", "A"): (1, 4), ("exists", "A"): (2, 5), ("exists", "B"): (1, 1), ("proportion", "A"): (1.5, 4.5), ("proportion", "B"): (0.5, 0.5)}
    freq = segments.with_frequency(segments.usage(data, segments=("v",)), ["repertoire_id", "field"]).groupBy("level", "mode", "productive").agg(F.sum("sequence_frequency").alias("f")).collect()
    assert all(abs(r.f - 1) < 1e-9 for r in freq)


def test_subgroup_falls_back_to_gene(spark, germline):
    got = resolve(rows(spark, {"v_call": "A*01,B*01"}), germline).select("v_subgroup", "v_allele").first()
    assert got.v_subgroup == ["A", "S"] and got.v_allele == ["A*01", "B*01"]


def test_combo_with_empty_d(spark, germline):
    data = resolve(rows(spark, {"v_call": "A*01", "j_call": "J1*01"}), germline)
    names = {c: {r.name for r in segments.combos(data, c, levels=("gene",)).collect()} for c in segments.COMBOS}
    assert names == {"vj": {"A|J1"}, "vd": {"A|NONE"}, "vdj": {"A|NONE|J1"}, "dj": {"NONE|J1"}}
    assert segments.combos(resolve(rows(spark, {"v_call": "Z*01", "j_call": "J1*01"}), germline), "vj").count() == 0


def test_lengths_and_letters(spark):
    data = rows(spark, {"junction_aa": "", "junction": ""}, {"junction_aa": "CASSF", "duplicate_count": 3, "productive": None}, {"junction_aa": "CXS", "junction_aa_length": 3, "junction": "ACG", "junction_length": 3})
    aa = {(r.length, r["count"]) for r in junction.lengths(data, "aa").where("not productive").collect()}
    assert aa == {(5, 3.0), (3, 1.0)}
    assert [r.length for r in junction.lengths(data, "nt").where("productive").collect()] == [3]
    assert junction.dense(junction.lengths(data, "aa").where("not productive"), ["repertoire_id", "productive"]).count() == 6
    letters = junction.distribution(data, "aa").where("not productive")
    assert letters.count() == 5 * 20 and letters.agg(F.sum("count")).first()[0] == 5


def test_share_levels_and_differences(spark, germline):
    data = resolve(rows(spark, *[{"repertoire_id": f"rep{k}", "junction_aa": j, "v_call": "A*01"} for k, j in ((0, "X"), (1, "X"), (0, "X"), (2, "Y"))]), germline)
    shares = sharing.shares(data, ("aa", "v,aa", "unknown"))
    assert {r.level for r in shares.collect()} == {"aa", "v,aa"}
    members = spark.createDataFrame([("g", f"rep{k}") for k in range(3)], "repertoire_group_id string, repertoire_id string")
    got = {r.cdr3: (r.share_level, r.sequence_count) for r in sharing.group_shares(shares, members).where("level = 'aa'").collect()}
    assert got == {"X": (2, 3), "Y": (1, 1)}
    plain = shares.where("level = 'aa'")
    matrix = {(r.repertoire_id_a, r.repertoire_id_b): (r.n_shared, r.n_diff) for r in sharing.share_matrix(plain).collect()}
    assert matrix[("rep0", "rep1")] == (1, 0) and matrix[("rep0", "rep2")] == (0, 1) and matrix[("rep2", "rep2")] == (1, 0)
    assert {(r.repertoire_id_a, r.repertoire_id_b) for r in sharing.diff_detail(plain).collect()} == {("rep0", "rep2"), ("rep1", "rep2"), ("rep2", "rep0"), ("rep2", "rep1")}


def _merged(entries):
    left, out = sorted(entries, key=lambda c: (-c[2], c[0])), []
    while left:
        seed, rest, total = left[0], [], 0
        for c in left:
            if all(set(a.split(",")) & set(b.split(",")) for a, b in ((seed[1][0], c[1][0]), (seed[1][1], c[1][1]))):
                total += c[2]
            else:
                rest.append(c)
        out.append((seed[1][0], total))
        left = rest
    return sorted(out)


def test_greedy_merge(spark):
    rng, data, want = random.Random(5), [], {}
    for g in range(120):
        entries = [(f"i{k}", (",".join(sorted(rng.sample("ABCD", rng.randint(1, 2)))), rng.choice(["J", "K", "J,K"])), rng.randint(1, 6)) for k in range(rng.randint(1, 6))]
        entries = list({e[1]: e for e in entries}.values())
        data += [("r", f"x{g}", v, j, 1, d, i) for i, (v, j), d in entries]
        want[f"x{g}"] = _merged(entries)
    found = spark.createDataFrame(data, "repertoire_id string, junction_aa string, v string, j string, clone_count long, duplicate_count long, first_ord string")
    got: dict = {}
    for r in clones.merge(found).collect():
        got.setdefault(r.junction_aa, []).append((r.v, r.duplicate_count))
    assert {k: sorted(v) for k, v in got.items()} == want


def test_clone_keeps_the_last_weight_or_the_sum(spark, germline):
    data = resolve(rows(spark, {"v_call": "A*01", "j_call": "J1*01", "junction_aa": "CAS", "duplicate_count": 9}, {"v_call": "A*01", "j_call": "J1*01", "junction_aa": "CAS", "duplicate_count": 2},
                        {"locus": "IGH", "junction_aa": "CAS"}, {"productive": None, "junction_aa": "CAS"}, {"junction_aa": ""}), germline)
    assert [r.duplicate_count for r in clones.clones(data, "allele").collect()] == [2]
    assert [r.duplicate_count for r in clones.clones(data, "gene", dup_mode="sum").collect()] == [11]


def test_translation(spark):
    assert len([c for c in codon_table() if set(c) <= set("ACGT")]) == 64 and codon_table()["GGN"] == "G" and "NNN" not in codon_table()
    data = spark.createDataFrame([("ATGGGN...NNNTA-AT",), ("",), ("AT",), ("---atg",)], "s string")
    assert [r[0] for r in data.select(translate(F.col("s"))).collect()] == ["MG.XX", "", "", ".M"]


def test_ratios_and_group_statistics(spark):
    rolled = spark.createDataFrame([("a", "global", "all", 3, 0, 3, 0, 30, 10), ("a", "class", "fwr", 3, 0, 3, 0, 20, 7), ("a", "class", "cdr", 0, 0, 0, 0, 10, 3), ("b", "global", "all", 0, 0, 0, 0, 0, 0)],
                                   "repertoire_id string, scope string, part string, r long, s long, r_aa long, s_aa long, total long, total_aa long")
    got = {r.region_class: r.rsratio for r in mutations.region_ratios(rolled, ("repertoire_id",)).collect()}
    assert got["fwr"] == math.inf and math.isnan(got["cdr"])
    members = spark.createDataFrame([("g", x) for x in ("a", "b", "c")], "repertoire_group_id string, repertoire_id string")
    stats = {r.field: r for r in mutations.group_frequencies(rolled.withColumn("repertoire_group_id", F.lit("g"))).where("scope = 'global'").collect()}
    assert stats["freq"].N == 1 and abs(stats["freq"].avg - 0.1) < 1e-12 and stats["freq"]["std"] == 0
    values = spark.createDataFrame([("g", "a", "x", 1.0), ("g", "b", "x", 2.0)], "repertoire_group_id string, repertoire_id string, name string, v double")
    r = groups.group_mean_std(values, members, ["name"], ["v"]).first()
    assert (r.N, r.v_avg, r.v_std) == (3, 1.0, 1.0)


def test_shares_and_statistics_do_not_depend_on_the_order_of_rows(spark):
    """Sums of thirds, sevenths and tenths in two layouts are the same doubles; a row's shares make exactly one."""
    names = [["A"], ["A", "B", "C"], ["C", "A", "B", "D", "E", "F", "G"], [f"N{k}" for k in range(9)] + ["A"], []]
    rows = [("r", k % 3 > 0, 1 + k % 11, names[k % 5]) for k in range(400)]
    schema = "repertoire_id string, productive boolean, duplicate_count long, v_allele array<string>"
    both = []
    for order in (rows, sorted(rows, key=lambda r: (r[2], len(r[3])), reverse=True)):
        data = spark.createDataFrame(order, schema).repartition(5 if order is rows else 2).selectExpr("*", "v_allele AS v_gene", "v_allele AS v_subgroup")
        counts = segments.with_frequency(segments.usage(data, segments=("v",), totals=True), ["repertoire_id", "field"])
        both.append(sorted(counts.collect()))
    assert both[0] == both[1] and not {"sequence_total", "duplicate_total"} & set(counts.columns)
    a = next(r for r in both[0] if r.name == "A" and r.mode == "proportion" and r.level == "gene" and not r.productive)
    assert a.sequence_count == 80 + 80 / 3 + 80 / 7 + 80 / 10 and a.sequence_frequency == a.sequence_count / 320
    values = [("g", f"m{k}", "x", 0.1 * k) for k in range(50)]
    members = spark.createDataFrame([("g", f"m{k}") for k in range(60)], "repertoire_group_id string, repertoire_id string")
    frame = spark.createDataFrame(values, "repertoire_group_id string, repertoire_id string, name string, v double")
    one, two = (groups.group_mean_std(f, members, ["name"], ["v"]).first() for f in (frame.repartition(7), frame.orderBy(F.desc("v"))))
    every = [v for *_, v in values] + [0.0] * 10
    assert one == two and one.N == 60 and abs(one.v_avg - statistics.mean(every)) < 1e-12 and abs(one.v_std - statistics.stdev(every)) < 1e-12
    pooled = spark.createDataFrame([("g", "x"), ("g", "none has it")], "repertoire_group_id string, name string")
    assert {r.name: (r.N, r.v_avg, r.v_std) for r in groups.group_mean_std(frame, members, ["name"], ["v"], pooled).collect()} == {"x": (60, one.v_avg, one.v_std), "none has it": (60, 0.0, 0.0)}


@pytest.mark.parametrize(("spec", "want"), [
    ({"op": "!=", "content": {"field": "duplicate_count", "value": 3}}, ["s1"]),
    ({"op": "=", "content": {"field": "v_gene", "value": "A"}}, ["s0", "s1"]),
    ({"op": "!=", "content": {"field": "v_gene", "value": "B"}}, ["s0"]),
    ({"op": "~", "content": {"field": "locus", "value": "TRB"}}, []),
    ({"op": "=", "content": {"field": "nothing", "value": 1}}, []),
    ({"op": "contains", "content": {"field": "locus", "value": "RB"}}, ["s0", "s1", "s2"]),
    (None, ["s0", "s1", "s2"]),
])
def test_filters(spark, germline, spec, want):
    data = resolve(rows(spark, {"v_call": "A*01", "duplicate_count": 0}, {"v_call": "A*01,B*01", "duplicate_count": 5}, {"v_call": ""}), germline)
    assert [r.sequence_id for r in data.where(predicate(spec, data)).orderBy("sequence_id").collect()] == want


def test_wide_report_and_long_form(spark):
    values = {f"mu_count_{p}_{k}": 0 for p in range(1, 105) for k in "rs"} | {"mu_count_5_r": 2, "mu_count_30_s": 1}
    wide = spark.createDataFrame([("s0", *values.values())], "sequence_id string, " + ", ".join(f"{c} int" for c in values))
    long = mutations.from_wide(wide)
    assert long.count() == 104 and long.agg(F.sum("r"), F.sum("s")).first() == (2, 1)
    rolled = spark.createDataFrame([("a", "position", "5", 2, 0, 1, 0, 3, 1), ("a", "global", "all", 2, 0, 1, 0, 3, 1)], "repertoire_id string, scope string, part string, r long, s long, r_aa long, s_aa long, total long, total_aa long")
    row = mutations.wide_counts(rolled, ("repertoire_id",)).first()
    assert (row.mu_count_5_r, row.mu_total_count_5_aa, row.mu_count_r, row.mu_total_count) == (2, 1, 2, 3)


def test_spec_runs_and_rejects(spark, germline):
    data = rows(spark, *[{"repertoire_id": f"r{k % 2}", "v_call": "A*01", "j_call": "J1*01", "junction_aa": "CAS", "junction": "TGT"} for k in range(4)])
    members = spark.createDataFrame([("g", "r0"), ("g", "r1")], "repertoire_group_id string, repertoire_id string")
    out = run(Context(data, germline, members), [Calculation("gene_segment", ["usage", "combo"]), {"type": "CDR3", "operations": ["length", "distribution", "shared", "compare"], "levels": ["aa"]}, {"type": "clonal_assignment", "operations": ["TCR"]}, {"type": "filters"}])
    assert out["share_matrix"].count() == 4 and out["filtered"].count() == 4 and out["usage_groups"].where("name = 'A' and mode = 'exists' and level = 'gene' and field = 'v_call'").first().N == 2
    with pytest.raises(ValueError):
        run(Context(data), [{"type": "diversity"}])
    with pytest.raises(ValueError):
        run(Context(data), [{"type": "gene_segment", "operations": ["usage"]}])


def _mutated(spark, *values):
    """Rows with their mutation columns: position 5 of the first has two replacements, and so on."""
    data = rows(spark, *[{k: v for k, v in x.items() if k != "at"} for x in values])
    for p in range(1, 105):
        for k in "rs":
            hit = F.lit(0)
            for n, x in enumerate(values):
                hit = F.when(F.col("sequence_id") == f"s{n}", x["at"].get((p, k), 0)).otherwise(hit)
            data = data.withColumn(f"mu_count_{p}_{k}", hit)
    for r, n in (("fwr1", 26), ("cdr1", 12), ("fwr2", 17), ("cdr2", 10), ("fwr3", 39)):
        data = data.withColumn(r, F.lit("ACG" * (n - 1) + "..."))
    return data


def test_group_mutation_statistics_see_the_filter(spark, germline):
    data = _mutated(spark, {"repertoire_id": "a", "v_call": "A*01", "at": {(5, "r"): 2}}, {"repertoire_id": "a", "v_call": "B*01", "at": {}}, {"repertoire_id": "b", "v_call": "A*01", "at": {(30, "s"): 1}})
    members = spark.createDataFrame([(g, r) for g in ("all", "only_a") for r in ("a", "b")], "repertoire_group_id string, repertoire_id string")
    filters = {"only_a": {"op": "=", "content": {"field": "v_gene", "value": "A"}}}
    calc = Calculation("mutations", ["count", "frequency"], ["rearrangement", "repertoire", "v_gene", "repertoire_group"])
    out = run(Context(data, germline, members, filters), [calc])
    stats = {(r.repertoire_group_id, r.field): r for r in out["mutation_group_frequencies"].where("scope = 'global'").collect()}
    n = 99 * 3  # mutable letters of a row
    assert abs(stats["all", "freq_r"].avg - (2 / (2 * n) + 0) / 2) < 1e-12 and abs(stats["only_a", "freq_r"].avg - (2 / n + 0) / 2) < 1e-12
    wide = {r.repertoire_group_id: r for r in out["mutation_group_report"].collect()}
    assert len(out["mutation_group_report"].columns) == 2 + 3 * 480 and wide["only_a"].N == 2 and abs(wide["only_a"].mu_freq_r_avg - 1 / n) < 1e-12 and wide["all"].mu_freq_5_r_N == 2
    report = {r.repertoire_id: r for r in out["mutation_count_report_repertoire"].collect()}
    assert (report["a"].mu_seq_count, report["a"].mu_unique_r, report["b"].mu_unique_s, report["a"].mu_count_fwr1_r, report["a"].mu_total_count) == (2, 1, 1, 2, 2 * n)
    assert len(report["a"]) == 1 + 668
    row = {r.sequence_id: r for r in out["mutation_rows"].collect()}["s0"]
    assert (row.mu_count_r, row.mu_count_r_aa, row.mu_count_fwr1_r, row.mu_count_cdr1_s_aa, row.fwr1_aa[-1], row.mu_total_count_fwr1) == (2, 1, 2, 0, ".", 75)


def test_missing_lengths_are_filled_before_the_group_filter(spark, germline):
    data = rows(spark, {"junction_aa": "CASSF"}, {"junction_aa": "CAS", "junction_aa_length": 3})
    members = spark.createDataFrame([("g", "r")], "repertoire_group_id string, repertoire_id string")
    filters = {"g": {"op": "=", "content": {"field": "junction_aa_length", "value": 5}}}
    out = run(Context(data, germline, members, filters), [{"type": "CDR3", "operations": ["length"]}])
    assert [(r.length, r["count"]) for r in out["length_aa_groups"].where("count > 0 and not productive").collect()] == [(5, 1.0)]
    assert out["length_aa_group_repertoires"].where("not productive").count() == 6


def test_unknown_repertoires_and_members_are_errors(spark, germline):
    data = rows(spark, {"repertoire_id": "a", "v_call": "A*01"}, {"repertoire_id": "b", "v_call": "A*01"})
    known = spark.createDataFrame([("a",), ("b",)], "repertoire_id string")
    members = spark.createDataFrame([("g", "a"), ("g", "z")], "repertoire_group_id string, repertoire_id string")
    usage = [{"type": "gene_segment", "operations": ["usage"]}]
    assert {r.repertoire_id for r in run(Context(data, germline, repertoires=known, selected=["a"]), usage)["usage"].collect()} == {"a"}
    with pytest.raises(ValueError, match="lacks: q"):
        run(Context(data, germline, repertoires=known, selected=["a", "q"]), usage)
    with pytest.raises(ValueError, match=r"z \(g\)"):
        run(Context(data, germline, members, repertoires=known), usage)


def test_comparison_details_come_by_weight(spark, germline):
    data = resolve(rows(spark, *[{"repertoire_id": r, "junction_aa": j, "duplicate_count": n} for r, j, n in (("a", "X", 1), ("b", "X", 2), ("a", "Y", 9), ("b", "Y", 1))]), germline)
    groups_of = spark.createDataFrame([("g", "a"), ("h", "b")], "repertoire_group_id string, repertoire_id string")
    detail = sharing.by_weight(sharing.compare_groups(sharing.group_shares(sharing.shares(data, ("aa",)), groups_of)))
    assert [(r.cdr3, r.duplicate_count_a) for r in detail.collect()] == [("Y", 9), ("X", 2), ("X", 1), ("Y", 1)]


def test_tally_counts_what_rows_count(spark, germline):
    data = rows(spark, *[{"v_call": v, "d_call": d, "j_call": "J1*01", "duplicate_count": n, "productive": p} for v, d, n, p in (("A*01,B*01", None, 3, True), ("A*01", "", None, None), ("A*01,B*01", "", 4, False), (None, "Z", 2, True), ("", None, 1, True))])
    key = lambda df: sorted((*(str(r[c]) for c in sorted(df.columns)),) for r in df.collect())
    by_row = resolve(data, germline)
    assert key(segments.usage(by_row)) == key(segments.usage(resolve(segments.tally(data, apart=True), germline)))
    for combo, parts in segments.COMBOS.items():
        assert key(segments.combos(by_row, combo)) == key(segments.combos(resolve(segments.tally(data, segments=parts), germline, parts), combo))


@pytest.mark.parametrize("ranges", [2, 3, 64])
def test_clone_numbers_do_not_depend_on_the_ranges(spark, ranges):
    data = [("r" if k % 3 else "q", f"run-7.{k * 7919 % 1000:04d}") for k in range(300)] + [("one", "x"), ("é", "ab"), ("é", "ab\u00e9"), ("é", "abz")]
    got = clones.numbered(spark.createDataFrame(data, "repertoire_id string, first_ord string"), ranges).collect()
    for rep in {r for r, _ in data}:
        mine = sorted((r.clone_id, r.first_ord) for r in got if r.repertoire_id == rep)
        assert [x for _, x in mine] == sorted(x for r, x in data if r == rep) and [n for n, _ in mine] == list(range(1, len(mine) + 1))
    numbers = spark.createDataFrame([("r", k * 31 % 97) for k in range(97)], "repertoire_id string, first_ord long")
    assert all(r.clone_id == r.first_ord + 1 for r in clones.numbered(numbers, ranges).collect())


def test_plans_broadcast_dimensions_and_stay_out_of_python(spark, sf):
    for name in ("usage_exists", "group_usage_stats", "share_matrix_shared", "clone_collapse", "mutation_group_freq_stats"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
    assert "BroadcastNestedLoopJoin" in QUERIES["usage_exists"](spark, sf)._jdf.queryExecution().executedPlan().toString()


def test_resolution_by_join_is_the_same(spark, germline):
    data = rows(spark, {"v_call": "A*01,B*01,Z*09,A*02", "j_call": "J1*01"}, {"v_call": "", "d_call": None}, {"v_call": "Z*09"}, {"v_call": "B*01,A*01"})
    names = ["sequence_id", *[f"{s}_{level}" for s in "vdj" for level in ("allele", "gene", "subgroup")]]
    assert sorted(resolve(data, germline).select(names).collect()) == sorted(resolve_by_join(data, germline).select(names).collect())


def test_a_dictionary_too_large_to_broadcast_is_refused(spark):
    many = spark.range(5001).selectExpr("concat('L', id) label", "'' locus", "'' sequence_type", "'1' gene_designation", "cast(null as string) subgroup_designation")
    with pytest.raises(Exception, match="resolve_by_join"):
        resolve(rows(spark, {"v_call": "L1"}), many).collect()


def test_earlier_shares_are_not_added_twice(spark):
    kind = "level string, gene_key string, cdr3 string, repertoire_id string, sequence_count long, duplicate_count long"
    a, b = spark.createDataFrame([("aa", "", "X", "r", 1, 1)], kind), spark.createDataFrame([("aa", "", "X", "r", 5, 5), ("aa", "", "Y", "r", 2, 2)], kind)
    assert sorted((r.cdr3, r.sequence_count) for r in sharing.read_shares(a, b).collect()) == [("X", 1), ("Y", 2)]


def test_wide_frequency_report(spark, sf):
    from lymphoframe.plans.queries import _rolled

    rolled = _rolled("repertoire_id")(spark, sf)
    wide = mutations.wide_frequencies(mutations.frequencies(rolled, ("repertoire_id",)), mutations.region_ratios(rolled, ("repertoire_id",)), ("repertoire_id",))
    assert len(wide.columns) == 481
    row = wide.first()
    assert abs(row.mu_freq - row.mu_freq_r - row.mu_freq_s) < 1e-12 and abs(row.mu_ratio_fwr + row.mu_ratio_cdr - 1) < 1e-12 and all(row[c] is not None for c in wide.columns)
