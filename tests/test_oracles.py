"""Queries against DuckDB on the smallest tables: one or two of each family (the driver runs all)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from lymphoframe.plans.oracles import ORACLES
from lymphoframe.plans.queries import QUERIES

TABLES = ("nation", "lineitem")
CHECKED = ("germline_resolve", "group_missing_members", "filter_group_rows", "filter_ne", "filter_nested", "filter_contains_list", "clone_input_filter", "usage_frequency", "combo_vdj", "group_usage_stats",
           "length_dense", "length_table_stats", "distribution_nt", "group_distribution_stats", "share_rep_vj_aa", "share_group_detail", "share_matrix_shared_v", "share_matrix_diff", "share_detail_diff",
           "group_share_diff_gene", "group_share_matrix", "share_set_except", "clone_ids", "clone_assign_rows", "mutation_rows", "mutation_rep_counts", "mutation_j_subgroup_counts", "mutation_rs_ratio", "mutation_group_freq_stats", "mutation_group_ratio_stats",
           "group_length", "group_length_stats", "group_share_compare", "group_share_compare_gene", "clone_collapse", "mutation_translate", "mutation_group_wide",
           "share_matrix_shared", "share_detail_shared", "share_detail_diff_pairs", "group_share_compare_totals", "group_share_diff_absent", "group_share_diff", "clone_gene", "clone_allele_sum")


def _plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_duckdb(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = QUERIES[name](spark, sf)
    columns = sorted(got.columns)
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(_plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=repr)
    have = sorted((tuple(_plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    assert have and have == want


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
