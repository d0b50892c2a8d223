"""Mutation vectors read a batch at a time, against plain versions letter by letter."""

import random

import pytest
from pyspark.sql import functions as F

from lymphoframe.functions.codons import translate
from lymphoframe.operators import mutations
from lymphoframe.plans.queries import QUERIES
from lymphoframe.schema import POSITIONS, REGIONS
from lymphoframe.sources.fixtures import _mutated, mutation_lengths, mutation_sums, mutation_translations, mutation_vectors, views

ODD = [None, "", "A", "..", "...", "-.-", "ATG", "atgGGN", "ATGA", "ATG..", "A..T.-", "ſAAuß.", "éé.ATG", "日本語", "..." * 60, "ATG" * 200 + ".", "NNNRAYTRA---", "AT\n...G A"]


def _regions(spark):
    rng = random.Random(3)
    made = [tuple(rng.choice(ODD) if rng.random() < 0.6 else "".join(rng.choice("ACGTN.-") for _ in range(rng.randrange(130))) for _ in REGIONS) for _ in range(300)]
    full = [tuple("".join(rng.choice(("ACG", "...", "A--", "TTN")) for _ in range(last - first + 1)) for first, last in REGIONS.values()) for _ in range(50)]
    return made + full, spark.createDataFrame([(f"s{i}", *x) for i, x in enumerate(made + full)], "sequence_id string, " + ", ".join(f"{r} string" for r in REGIONS)).repartition(3)


def test_translations_of_odd_regions(spark):
    _, regions = _regions(spark)
    plain = regions.select("sequence_id", *[translate(F.col(r)).alias(f"{r}_aa") for r in REGIONS])
    assert sorted(mutations.region_translations(regions).collect()) == sorted(plain.collect())


def test_lengths_of_odd_regions(spark):
    made, regions = _regions(spark)
    got = {r.sequence_id: r for r in mutations.region_lengths(regions).collect()}
    for i, parts in enumerate(made):
        for region, x in zip(REGIONS, parts, strict=True):
            codons = [x[k : k + 3] for k in range(0, len(x) // 3 * 3, 3)] if x else []
            want = (None if x is None else sum(c not in ".-" for c in x), sum(bool(c.strip(".-")) for c in codons))
            assert (got[f"s{i}"][f"mu_total_count_{region}"], got[f"s{i}"][f"mu_total_count_{region}_aa"]) == want


def _mutable(parts):
    out = []
    for x, (first, last) in zip(parts, REGIONS.values(), strict=True):
        cells = [c.replace("-", ".") != "..." for c in ((x or "")[k : k + 3] for k in range(0, len(x or ""), 3))]
        out += (cells + [False] * (last - first + 1))[: last - first + 1]
    return out


def test_sums_of_many_keys_and_large_weights(spark):
    made, regions = _regions(spark)
    keys = [None, ("a", None), (), ("b",)]
    counts = [F.lit(0 if p % 3 else 2).cast("string").alias(f"mu_count_{p}_r") for p in range(1, POSITIONS + 1)] + [F.when(F.lit(p % 2 == 0), F.lit(1)).alias(f"mu_count_{p}_s") for p in range(1, POSITIONS + 1)]
    n = F.substring("sequence_id", 2, 9).cast("int")
    listed = F.when(n % 4 == 0, F.lit(None)).when(n % 4 == 1, F.array(F.lit("a"), F.lit(None))).when(n % 4 == 2, F.array().cast("array<string>")).otherwise(F.array(F.lit("b")))
    rows = regions.select("*", *counts, listed.alias("key"), F.shiftleft(n.cast("bigint"), 40).alias("w"))
    got = {(None if r.key is None else tuple(r.key), r.pos): r for r in mutations.summed_vectors(mutations.from_rows(rows, "key", "w"), ("key",)).collect()}
    assert len(got) == 4 * POSITIONS
    for k, key in enumerate(keys):
        mine = [(i << 40, _mutable(x)) for i, x in enumerate(made) if i % 4 == k]
        for p in range(1, POSITIONS + 1):
            w, t, row = sum(x for x, _ in mine), sum(x for x, m in mine if m[p - 1]), got[key, p]
            assert (row.r, row.s, row.r_aa, row.s_aa, row.total, row.total_aa) == (0 if p % 3 else 2 * w, 0 if p % 2 else w, 0 if p % 3 else w, 0 if p % 2 else w, 3 * t, t)
    many = rows.crossJoin(spark.range(20).withColumnRenamed("id", "copy")).withColumn("w", F.lit(1)).withColumn("sequence_id", F.concat("sequence_id", F.lit("-"), "copy")).coalesce(1)
    found = mutations.summed_vectors(mutations.from_rows(many, "w"), ("sequence_id",))  # more keys than a task keeps
    assert found.groupBy("pos").agg(F.count("*").alias("n"), F.sum("s").alias("s")).where(f"n <> {20 * len(made)} or s <> n * IF(pos % 2 = 0, 1, 0)").isEmpty()


def test_a_sum_beyond_a_long_fails(spark):
    _, regions = _regions(spark)
    rows = regions.limit(4).select("*", *[F.lit(3).alias(f"mu_count_{p}_{k}") for p in range(1, POSITIONS + 1) for k in "rs"], F.lit(2**62).alias("w"))
    with pytest.raises(Exception):
        mutations.summed_vectors(mutations.from_rows(rows, "w"), ()).collect()



@pytest.mark.parametrize("name", ["mutation_rows", "mutation_translate", "mutation_region_lengths", "mutation_row_counts", "mutation_row_region_counts", "mutation_pos_counts", "mutation_totals", "mutation_clone_counts", "mutation_v_call_counts", "mutation_j_gene_counts", "mutation_freq_pos", "mutation_rs_ratio"])
def test_rows_are_read_by_batch_not_letter_by_letter(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    before = plan[plan.index("MapInArrow") :]  # what is computed row by row, before any aggregate
    assert "lambda" not in before and "regexp" not in before


@pytest.mark.parametrize("name", ["mutation_region_lengths", "mutation_rep_counts", "mutation_totals", "mutation_freq_global", "mutation_v_subgroup_counts", "mutation_clone_counts"])
def test_regions_are_made_and_vectors_summed_in_one_pass(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "translate(" not in plan and "rpad(" not in plan


@pytest.mark.parametrize("name", ["mutation_j_gene_counts", "mutation_v_call_counts", "mutation_region_ratio", "mutation_totals", "mutation_unique_positions", "mutation_rep_counts", "mutation_pos_counts", "mutation_freq_pos"])
def test_a_run_reads_the_rows_once_and_only_sums_leave_the_tasks(spark, sf, name):
    found = QUERIES[name](spark, sf)
    assert found.collect()
    run = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert run.count("MapInArrow") == 1 and run.count("lineitem.parquet") == 1
    assert all(c not in found._jdf.queryExecution().optimizedPlan().toString() for c in ("translate(md5", "translate(concat(md5", "rpad("))


def test_regions_by_batch_are_those_of_the_view(spark, sf):
    rows, _ = views(spark, sf, "rearrangements", "germline")
    n = F.abs(F.hash("sequence_id"))
    odd = rows.withColumn("jk", F.when(n % 3 == 0, -F.col("jk")).otherwise(F.col("jk"))).withColumn("sequence_id", F.when(n % 11 == 0, None).when(n % 13 == 0, "").otherwise(F.col("sequence_id")))
    odd = odd.withColumn("w", F.when(n % 5 == 0, F.lit(2**40)).otherwise(F.col("duplicate_count")))
    for each in (odd.where("false"), odd):
        made = spark.sql(_mutated("{rows}"), rows=each)
        told = mutation_vectors(spark, each, *REGIONS)
        assert sorted(told.select("sequence_id", *REGIONS).collect(), key=str) == sorted(made.select("sequence_id", *REGIONS).collect(), key=str)
        assert sorted(mutation_lengths(each).collect(), key=str) == sorted(mutations.region_lengths(made).collect(), key=str)
        assert sorted(mutation_translations(each).collect(), key=str) == sorted(mutations.region_translations(made).collect(), key=str)
        for by in ((), ("repertoire_id", "clone_id")):
            sums, apart = mutation_sums(each, by), mutations.summed_vectors(mutation_vectors(spark, each, *by, "w"), by)
            assert sorted(sums.collect(), key=str) == sorted(apart.collect(), key=str)
