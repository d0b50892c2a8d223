"""Repertoires and repertoire groups: selection, membership, group rows, group means."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lymphoframe.functions.calls import MOST_LABELS, germline_names
from lymphoframe.functions.predicates import LabelSets, predicate


def select_repertoires(rows: DataFrame, selected: DataFrame) -> DataFrame:
    """Rows of the selected repertoires (a dimension table; Spark broadcasts it while it is small)."""
    return rows.join(selected.select("repertoire_id").distinct(), "repertoire_id", "left_semi")


def missing_members(members: DataFrame, repertoires: DataFrame) -> DataFrame:
    """Group members that no repertoire is known for."""
    return members.join(repertoires.select("repertoire_id"), "repertoire_id", "left_anti").select("repertoire_group_id", "repertoire_id")


def group_condition(filters: dict[str, dict], frame: DataFrame) -> Column:
    """True where the row passes the filter of its group (groups without one take all rows)."""
    out = F.lit(True)
    for group, spec in filters.items():
        out = F.when(F.col("repertoire_group_id") == group, predicate(spec, frame)).otherwise(out)
    return out


def group_rows(rows: DataFrame, members: DataFrame, filters: dict[str, dict]) -> DataFrame:
    """One copy of a row per group that its repertoire is in and whose filter it passes."""
    joined = rows.join(members.select("repertoire_group_id", "repertoire_id").distinct(), "repertoire_id")
    return joined.where(group_condition(filters, rows))


#: Tests whose results one long holds.
_BITS = 62


def with_passed(rows: DataFrame, filters: dict[str, dict], germline: DataFrame | None = None) -> DataFrame:
    """Rows with ``passed``: the groups with a filter whose filter the row passes. A row stays one row: aggregates
    take ``passed`` as a key beside the repertoire, and ``regrouped`` makes groups of their results. With a germline
    set of at most ``MOST_LABELS`` the rows' calls need not be resolved: their labels are looked for among those of
    the names that filters ask for."""
    sets = LabelSets()
    tests = [predicate(spec, rows) if germline is None else predicate(spec, rows, sets.test) for _, spec in sorted(filters.items())]
    asked = sets.row(germline_names(germline), MOST_LABELS) if germline is not None else None
    joined = rows if asked is None else rows.crossJoin(F.broadcast(asked))
    # bits first: Spark compiles no code for what stands under the lambda of array_compact
    parts = range(0, len(tests), _BITS)
    bits = [reduce(Column.bitwiseOR, [F.when(test, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, test in enumerate(tests[k : k + _BITS])]) for k in parts]
    tested = joined.select(*rows.columns, *[b.alias(f"_bits{k}") for k, b in zip(parts, bits, strict=True)])
    hits = [F.when(F.col(f"_bits{i // _BITS * _BITS}").bitwiseAND(F.lit(1 << i % _BITS).cast("bigint")) != 0, F.lit(group)) for i, group in enumerate(sorted(filters))]
    passed = F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")
    return tested.select(*rows.columns, passed.alias("passed"))


def regrouped(results: DataFrame, members: DataFrame, filters: dict[str, dict]) -> DataFrame:
    """Results by (repertoire_id, passed, ...) with ``repertoire_group_id``: a copy for each group of the repertoire that
    has no filter or whose filter the rows behind the result passed. What is additive is then summed by
    group; the rows themselves are never read again, nor copied."""
    joined = results.join(members.select("repertoire_group_id", "repertoire_id").distinct(), "repertoire_id")
    free = ~F.col("repertoire_group_id").isin(*filters) if filters else F.lit(True)
    return joined.where(free | F.array_contains("passed", F.col("repertoire_group_id"))).drop("passed")


def mean_std(values: Column, n: Column | None = None) -> Column:
    """struct<avg, std> of an array of doubles; ``n``: how many values there are, those beyond the array 0. One value
    has deviation 0, none has no avg. Values are added in the array's order: sort it, and the result doesn't depend
    on the order of rows and tasks."""
    n = F.size(values) if n is None else n

    def of(mean: Column) -> Column:
        squares = F.aggregate(values, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)) + (n - F.size(values)) * (mean * mean)
        return F.struct(mean.alias("avg"), F.when(n > 1, F.sqrt(squares / (n - 1))).otherwise(0.0).alias("std"))

    mean = F.when(n > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / n)
    return F.transform(F.array(mean), of)[0]


def by_repertoire(*measures: Column) -> Column:
    """The aggregate that ``mean_std`` takes its arrays from: a group's values in the order of its repertoires."""
    return F.sort_array(F.collect_list(F.struct("repertoire_id", *measures)))


def group_mean_std(values: DataFrame, members: DataFrame, keys: list[str], measures: list[str], pooled: DataFrame | None = None) -> DataFrame:
    """Mean and sample deviation of per-repertoire ``values`` (one row per group, repertoire and keys) over all
    members of a group; an absent value counts 0, and one member has deviation 0. ``pooled`` names the keys of each
    group (by default every key that a member has). Absent values are counted, never made: a key's list is as long
    as the members that have it."""
    distinct = members.select("repertoire_group_id", "repertoire_id").distinct()
    sizes = distinct.groupBy("repertoire_group_id").agg(F.count("*").alias("N"))
    of_members = values.join(distinct, ["repertoire_group_id", "repertoire_id"], "left_semi")
    lists = of_members.groupBy("repertoire_group_id", *keys).agg(by_repertoire(*[F.coalesce(F.col(m), F.lit(0)).cast("double").alias(m) for m in measures]).alias("_values"))
    grid = lists
    if pooled is not None:
        grid = pooled.select("repertoire_group_id", *keys).distinct().join(lists, ["repertoire_group_id", *keys], "left")
    stats = [mean_std(F.coalesce(F.col(f"_values.{m}"), F.array().cast("array<double>")), F.col("N")).alias(f"_{m}") for m in measures]
    found = grid.join(sizes, "repertoire_group_id").select("repertoire_group_id", *keys, "N", *stats)
    return found.select("repertoire_group_id", *keys, "N", *[F.col(f"_{m}.{x}").alias(f"{m}_{x}") for m in measures for x in ("avg", "std")])
