"""Clones of any number by rounds, numbering over ranges, and comparisons with units that have nothing."""

import random

from pyspark.sql import functions as F

from lymphoframe.operators import clones, sharing
from lymphoframe.plans.queries import QUERIES

FOUND = "repertoire_id string, junction_aa string, v string, j string, clone_count long, duplicate_count long, first_ord long"


def greedy(data):
    """Seeds by cell: each clone in its turn goes to the first seed it shares a pair of names with."""
    out, seed_of = {}, {}
    for rep, junction, v, j, n, d, first in sorted(data, key=lambda c: (c[0], c[1], -c[5], c[6], c[2], c[3])):
        cells = [(rep, junction, a, b) for a in v.split(",") for b in j.split(",")]
        met = [seed_of[c] for c in cells if c in seed_of]
        if met:
            mine = min(met)
        else:
            mine = (rep, junction, -d, first, v, j)
            seed_of.update(dict.fromkeys(cells, mine))
            out[mine] = [0, 0]
        out[mine][0] += n
        out[mine][1] += d
    return sorted((m[0], m[1], m[4], m[5], n, d, m[3]) for m, (n, d) in out.items())


def drawn(number, names, rng, junctions=1):
    data = {}
    for k in range(number):
        v = ",".join(map(str, rng.sample(range(names), rng.choice([1, 1, 2, 3]))))
        j = ",".join(map(str, rng.sample(range(60), rng.choice([1, 1, 2]))))
        key = (f"r{k % 2}" if junctions > 1 else "r", f"J{k % junctions}", v, j)
        data[key] = (*key, 1 + k % 3, rng.randint(1, 40), k)
    return list(data.values())


def merged(frame):
    return sorted((r.repertoire_id, r.junction_aa, r.v, r.j, r.clone_count, r.duplicate_count, r.first_ord) for r in frame.collect())


def test_rounds_and_fold_agree_with_the_greedy_order(spark, monkeypatch):
    data = drawn(900, 8, random.Random(3), junctions=40) + [("r0", "chain", f"{k},{k + 1}", "1", 1, 50 - k, k) for k in range(7)] + [("r0", "none", "", "", 2, 3, 1), ("r0", "none", "1", "", 1, 1, 2)]
    found = spark.createDataFrame(data, FOUND)
    want = greedy(data)
    assert merged(clones.merge_by_fold(found)) == want
    assert merged(clones.merge_by_rounds(found)) == want
    monkeypatch.setattr(clones, "FEW", 12)
    assert merged(clones.merge(found)) == want
    assert merged(clones.merge_by_rounds(found.where("false"))) == []


def test_a_hundred_thousand_clones_of_one_junction(spark):
    data = drawn(100_000, 400, random.Random(8))
    import pandas as pd

    found = spark.createDataFrame(pd.DataFrame(data, columns=[c.split()[0] for c in FOUND.split(", ")]), FOUND).repartition(8)
    assert merged(clones.merge(found)) == greedy(data)


def _files(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("lineitem.parquet")


def test_ids_and_merge_read_the_rows_once(spark, sf):
    """What a clone query returns reads written tables; the rows were scanned when these were made."""
    for name in ("clone_ids", "clone_collapse", "share_detail_diff", "group_share_matrix", "share_matrix_shared"):
        assert _files(QUERIES[name](spark, sf)) == 0, name
    for name in ("group_share_compare", "share_detail_shared", "clone_gene"):
        assert _files(QUERIES[name](spark, sf)) == 1, name
        assert "lineitem" in QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


def test_ties_in_the_order_are_numbered_by_the_key(spark):
    data = [("r", f"J{k}", "v", "j", 1, 1, k // 3) for k in range(30)]
    got = clones.numbered(spark.createDataFrame(data, FOUND), 4).collect()
    assert [(r.first_ord, r.junction_aa) for r in sorted(got, key=lambda r: r.clone_id)] == sorted((d[6], d[1]) for d in data)


SHARES = "level string, gene_key string, cdr3 string, repertoire_id string, sequence_count long, duplicate_count long"
ROWS = [("aa", "", "CAS", "r1", 1, 2), ("aa", "", "CAS", "r2", 1, 3), ("aa", "", "CAT", "r1", 2, 5), ("v,aa", "V1", "CAS", "r1", 1, 2), ("v,aa", "V2", "CAS", "r2", 1, 3)]


def test_units_without_junctions_take_part(spark):
    shares = spark.createDataFrame(ROWS, SHARES)
    units = spark.createDataFrame([("r1",), ("r2",), ("r3",), (None,)], "repertoire_id string")
    matrix = {(r.level, r.repertoire_id_a, r.repertoire_id_b): (r.n_shared, r.n_diff) for r in sharing.share_matrix(shares, units, ("aa", "v,aa", "vj,aa", "other")).collect()}
    assert len(matrix) == 27
    assert matrix["aa", "r1", "r2"] == (1, 1) and matrix["aa", "r1", "r3"] == (0, 2) and matrix["aa", "r3", "r1"] == (0, 0) and matrix["aa", "r3", "r3"] == (0, 0)
    assert matrix["v,aa", "r1", "r2"] == (0, 1) and matrix["vj,aa", "r1", "r1"] == (0, 0)
    diff = lambda **k: sorted((r.level, r.cdr3, r.repertoire_id_a, r.repertoire_id_b, r.sequence_count_a) for r in sharing.diff_detail(shares, **k).collect())
    whole = [("aa", "CAS", "r1", "r3", 1), ("aa", "CAS", "r2", "r3", 1), ("aa", "CAT", "r1", "r2", 2), ("aa", "CAT", "r1", "r3", 2)]
    assert diff(units=units) == whole  # a gene that B lacks is passed over
    assert diff() == [whole[2]]
    assert diff(units=units, pairs=[("r1", "r3"), ("r3", "r1"), ("r9", "r1")]) == [whole[0], whole[3]]
    assert diff(units=units, keep_absent_genes=True) == sorted(whole + [("v,aa", "CAS", a, b, 1) for a in ("r1", "r2") for b in ("r1", "r2", "r3") if a != b])
    members = spark.createDataFrame([("a", "r1"), ("a", "r2"), ("b", "r2"), ("empty", "r3")], "repertoire_group_id string, repertoire_id string")
    by_group = sharing.group_shares(shares.where("level = 'aa'"), members)
    gone = sorted((r.cdr3, r.repertoire_group_id_a, r.repertoire_group_id_b) for r in sharing.diff_groups(by_group, members).collect())
    assert gone == [("CAS", "a", "empty"), ("CAS", "b", "empty"), ("CAT", "a", "b"), ("CAT", "a", "empty")]
    levels = {(r.repertoire_group_id_a, r.repertoire_group_id_b, r.share_level_a, r.share_level_b): r.n for r in sharing.group_matrix(shares.where("level = 'aa'"), members).collect()}
    assert levels == {("a", "b", 1, 1): 0, ("a", "b", 2, 1): 1, ("b", "a", 1, 1): 0, ("b", "a", 1, 2): 1}
    none = shares.where("false")
    assert sharing.share_matrix(none).collect() == [] and sharing.diff_detail(none).collect() == [] and sharing.group_matrix(none, members).collect() == []


def test_bitmaps_of_many_units(spark):
    rng = random.Random(4)
    rows = [("aa", "", f"C{k}", f"r{u:03d}", 1, 1) for k in range(40) for u in rng.sample(range(200), rng.randint(1, 60))]
    shares = spark.createDataFrame(rows, SHARES)
    sets = {}
    for r in rows:
        sets.setdefault(r[3], set()).add(r[2])
    got = {(r.repertoire_id_a, r.repertoire_id_b): (r.n_shared, r.n_diff) for r in sharing.share_matrix(shares).collect()}
    assert got == {(a, b): (len(x & y), len(x - y)) for a, x in sets.items() for b, y in sets.items()}


def test_more_units_than_a_comparison_takes_are_refused(spark, monkeypatch):
    monkeypatch.setattr(sharing, "MOST_UNITS", 2)
    try:
        sharing.unit_ids(spark.range(3).select(F.concat(F.lit("r"), "id").alias("repertoire_id")), "repertoire_id")
    except ValueError as e:
        assert "more than 2" in str(e)
    else:
        raise AssertionError


def test_calculations_share_one_scan(spark, tmp_path, monkeypatch):
    from lymphoframe.plans import shared
    from lymphoframe.plans.queries import FILTERS, views
    from lymphoframe.plans.spec import Context, run

    sf = "/root/testdata/sf0.001"
    rows, germline, members = views(spark, sf, "rearrangements", "germline", "group_members")
    rows.write.parquet(f"{tmp_path}/source")
    source = spark.read.parquet(f"{tmp_path}/source")
    counted = []
    monkeypatch.setattr(shared.Shared, "_count", lambda self, f=shared.Shared._count: counted.append(1) or f(self))
    out = run(Context(source, germline, members, FILTERS), [{"type": "gene_segment", "operations": ["usage", "combo"]}, {"type": "CDR3", "operations": ["length", "distribution", "shared", "compare"], "levels": ["aa", "v,aa", "vj,nucleotide"]}, {"type": "clonal_assignment", "levels": ["allele", "gene"]}])
    assert counted == [1]
    reading = {name for name, df in out.items() if f"{tmp_path}/source" in df._jdf.queryExecution().optimizedPlan().toString() or any("/source/" in f for f in df.inputFiles())}
    assert reading == {"clone_rows_allele", "clone_rows_gene"}  # reports of rows
    # the same as the operators on rows
    from lymphoframe.functions.calls import resolve
    from lymphoframe.operators import groups, junction, segments

    named = resolve(rows, germline)
    key = lambda df, *drop: sorted(tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for _, v in sorted(r.asDict().items())) for r in df.drop(*drop).collect())
    assert key(out["usage"], "sequence_frequency", "duplicate_frequency") == key(segments.usage(named))
    assert key(out["vdj_combo"], "sequence_frequency", "duplicate_frequency") == key(segments.combos(named, "vdj"))
    assert key(out["distribution_nt"]) == key(junction.distribution(rows, "nt"))
    assert key(out["share_repertoires"]) == key(sharing.shares(named, ("aa", "v,aa", "vj,nucleotide")))
    assert key(out["clones_gene"]) == key(clones.clones(named, "gene"))
    measured = junction.with_length(named)
    pooled = junction.lengths(groups.group_rows(measured, members, FILTERS), "aa", ("repertoire_group_id",))
    assert key(out["length_aa_groups"].where("count > 0"), "relative") == key(pooled)
    by_member = segments.usage(groups.group_rows(named, members, FILTERS), ("repertoire_group_id", "repertoire_id"))
    assert key(out["usage_group_repertoires"], "sequence_frequency", "duplicate_frequency") == key(by_member)


def test_packed_vectors_and_long_form_agree(spark):
    from lymphoframe.operators import mutations
    from lymphoframe.plans.queries import views
    from lymphoframe.sources.fixtures import mutation_vectors

    rows, long = views(spark, "/root/testdata/sf0.001", "rearrangements", "mutation_positions")
    vectors = mutation_vectors(spark, rows.withColumn("w", F.coalesce("duplicate_count", F.lit(1))), "repertoire_id", "w")
    columns = ["sequence_id", "pos", "region", "region_class", "r", "s", "mutable"]
    assert mutations.spelled_out(vectors).select(columns).exceptAll(long.select(columns)).isEmpty()
    by = ("repertoire_id",)
    columns = ["repertoire_id", "pos", "region", "region_class", *mutations.SUMS]
    packed, plain = mutations.summed_vectors(vectors, by).select(columns), mutations.weighted(long, rows, by).select(columns)
    assert packed.count() == plain.count() == 8 * 104 and packed.exceptAll(plain).isEmpty()
