"""Filters of groups on calls that nobody has named, against the same filters on resolved calls."""

from pyspark.sql import functions as F

from lymphoframe.functions.calls import resolve
from lymphoframe.operators.groups import with_passed
from lymphoframe.plans import queries

GERMLINE = [("A*01", "IGH", "V", "1-1", "1"), ("A*02", "IGH", "V", "1-1", "1"), ("B*01", "IGH", "V", "2", None), ("N*01", "IGH", "V", None, None), ("J1*01", "IGH", "J", "1", "1"), ("", "IGH", "D", "9", "9")]
CALLS = [None, "", "A*01", "A*02,B*01", "B*01", "Z*01", "Z*01,B*01,B*01", "N*01", "N*01,A*01", ",", "A*01,", "J1*01"]


def _leaf(op, field, value):
    return {"op": op, "content": {"field": field, "value": value}}


def test_filters_on_labels_equal_filters_on_names(spark):
    germline = spark.createDataFrame(GERMLINE, "label string, locus string, sequence_type string, gene_designation string, subgroup_designation string")
    rows = spark.createDataFrame([(f"s{i}-{k}", v, j, k) for i, v in enumerate(CALLS) for k, j in enumerate(CALLS)], "sequence_id string, v_call string, j_call string, n int")
    values = {"v_call": "A*01", "v_gene": "IGHV1-1", "v_subgroup": "IGHV2", "j_gene": "IGHJ1", "j_subgroup": "none such"}
    leaves = [_leaf(op, f, x) for op in ("=", "!=", "contains", "<", "odd") for f, x in values.items()]
    filters = {f"g{i}": spec for i, spec in enumerate([*leaves, {}, _leaf(">", "n", 3)])}
    filters |= {f"h{i}": {"op": op, "content": [a, b, _leaf("!=", "n", 2)]} for i, (a, b) in enumerate(zip(leaves[:20], leaves[3:23], strict=True)) for op in ("and",)}
    filters |= {f"k{i}": {"op": "or", "content": [a, b]} for i, (a, b) in enumerate(zip(leaves[:20], leaves[5:25], strict=True))}
    assert len(filters) > 62
    want = {r.sequence_id: r.passed for r in with_passed(resolve(rows, germline, ("v", "j")), filters).select("sequence_id", "passed").collect()}
    found = with_passed(rows, filters, germline)
    assert found.columns == [*rows.columns, "passed"]
    got = {r.sequence_id: r.passed for r in found.collect()}
    assert got == want and len({tuple(x) for x in want.values()}) > 20
    assert {tuple(r.passed) for r in with_passed(rows, {}, germline).collect()} == {()}
    assert {r.sequence_id for r in with_passed(rows, {"g": _leaf("=", "v_gene", "IGHV2")}, germline).where(F.size("passed") > 0).collect()} == {f"s{i}-{k}" for i in (3, 4, 6) for k in range(len(CALLS))}


def test_group_rows_carry_no_dictionary_and_name_no_call(spark, sf):
    plan = queries._passed_rows(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "map_from_entries" not in plan and "element_at" not in plan
    tests = [line for line in plan.splitlines() if "arrays_overlap" in line]
    assert tests and not any("lambda" in line for line in tests)  # the tests stand apart from the lambda, so they are compiled
