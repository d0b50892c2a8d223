"""Gene segment usage and segment combinations.

``tally`` first counts the rows of each distinct call (a few thousand per repertoire, whatever the
rows), so that names are resolved and fanned out on the tally and not row by row. One fan-out and one
aggregate then give all levels, fields and the three modes of counting ambiguous calls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lymphoframe.functions.calls import is_productive, weight
from lymphoframe.schema import LEVELS, SEGMENTS

#: Combinations: key -> segments in the order of their names.
COMBOS = {"vj": ("v", "j"), "vd": ("v", "d"), "vdj": ("v", "d", "j"), "dj": ("d", "j")}
_MEASURES = ("sequence_count", "duplicate_count")


def tally(rows: DataFrame, by: tuple[str, ...] = ("repertoire_id",), segments: tuple[str, ...] = SEGMENTS, apart: bool = False) -> DataFrame:
    """by, productive, the segments' calls and how many rows (``rows``) with what weight (``weights``)
    have them. ``apart``: each segment's call is counted on its own, the other calls are null."""
    calls = [f"{s}_call" for s in segments]
    measured = rows.select(*by, is_productive().alias("productive"), *calls, weight().alias("w"))
    if apart and len(segments) > 1:
        one = lambda c: F.struct(*[(F.coalesce(x, F.lit("")) if x == c else F.lit(None).cast("string")).alias(x) for x in calls])
        measured = measured.select(*by, "productive", "w", F.explode(F.array(*[one(c) for c in calls])).alias("x")).select(*by, "productive", "w", "x.*")
    return measured.groupBy(*by, "productive", *calls).agg(F.count("*").alias("rows"), F.sum("w").alias("weights"))


def _measures(resolved: DataFrame) -> list[Column]:
    """The number and weight of what a row stands for: itself, or the rows of a tally."""
    if "weights" in resolved.columns:
        return [F.col("rows").cast("bigint").alias("rows"), F.col("weights").cast("bigint").alias("w")]
    return [F.lit(1).cast("bigint").alias("rows"), weight().cast("bigint").alias("w")]


#: What a part counts, all of it in integers: rows and their weights, and of both what is counted at a row's first name.
_PARTS = ("rows", "w", "head_rows", "head_w")


def _parts(named: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with ``name``, ``n`` (names of the row), ``head`` (whether it is the row's first name), ``rows`` and ``w`` ->
    integer sums by keys, productive, name and n, for all and for productive rows."""
    rows = named.withColumn("productive", F.explode(F.when(is_productive(), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    heads = [F.sum(F.when(F.col("head"), F.col(c)).otherwise(0)).alias(f"head_{c}") for c in ("rows", "w")]
    return rows.groupBy(*keys, "productive", "name", "n").agg(F.sum("rows").alias("rows"), F.sum("w").alias("w"), *heads)


def finished(parts: DataFrame, keys: list[str], totals: bool = False) -> DataFrame:
    """Counts by mode, of ``parts``. Shares of ambiguous rows are integer sums divided by n, added from the
    smallest n on: the same double whatever the order of rows and tasks. ``totals`` adds sequence_total and
    duplicate_total, exact numbers whose sum over the names of (keys, level, productive) is the mode's total."""
    one = F.col("n") == 1
    gathered = parts.groupBy(*keys, "productive", "name").agg(
        *[F.sum(F.when(one, F.col(c)).otherwise(0)).alias(f"u_{c}") for c in _PARTS[:2]], *[F.sum(c).alias(c) for c in _PARTS],
        F.sort_array(F.collect_list(F.struct("n", *[F.col(c).alias(f"p_{c}") for c in _PARTS[:2]]))).alias("by_n"))
    share = lambda c: F.aggregate("by_n", F.lit(0.0), lambda a, x: a + x[c] / x["n"])
    modes = [("unique", F.col("u_rows"), F.col("u_w"), F.col("u_rows"), F.col("u_w")), ("exists", F.col("rows"), F.col("w"), F.col("rows"), F.col("w")),
             ("proportion", share("p_rows"), share("p_w"), F.col("head_rows"), F.col("head_w"))]
    names = (*_MEASURES, "sequence_total", "duplicate_total")
    entries = F.array(*[F.struct(F.lit(m).alias("mode"), *[v.cast("double").alias(c) for c, v in zip(names, values, strict=True)]) for m, *values in modes])
    out = gathered.select(*keys, "productive", "name", F.explode(entries).alias("x")).select(*keys, "productive", "name", "x.*").where("sequence_count > 0")
    return out if totals else out.drop(*names[2:])


def usage_parts(resolved: DataFrame, by: tuple[str, ...] = ("repertoire_id",), segments: tuple[str, ...] = SEGMENTS) -> DataFrame:
    """The integer sums that ``usage`` is made of, one aggregate (also over a stream)."""
    lists = F.array(*[F.struct(F.lit(f"{s}_call").alias("field"), F.lit(level).alias("level"), F.col(f"{s}_{level}").alias("names")) for s in segments for level in LEVELS])
    rows = resolved.select(*by, "productive", *_measures(resolved), F.explode(lists).alias("x"))
    named = rows.select(*by, "productive", "rows", "w", "x.field", "x.level", F.size("x.names").alias("n"), F.posexplode("x.names").alias("p", "name"))
    return _parts(named.withColumn("head", F.col("p") == 0), [*by, "field", "level"])


def usage(resolved: DataFrame, by: tuple[str, ...] = ("repertoire_id",), segments: tuple[str, ...] = SEGMENTS, totals: bool = False) -> DataFrame:
    """by, field, level, mode, productive, name, sequence_count, duplicate_count, over resolved rows or a
    resolved ``tally``.

    ``productive`` false means all rows, true the productive ones."""
    return finished(usage_parts(resolved, by, segments), [*by, "field", "level"], totals)


def combos(resolved: DataFrame, combo: str, by: tuple[str, ...] = ("repertoire_id",), levels: tuple[str, ...] = LEVELS, totals: bool = False) -> DataFrame:
    """by, combo, level, mode, productive, name, counts; name = v|d|j of one level. A row without a v
    or j name counts in no combination that has that segment; an empty d is NONE."""
    parts = COMBOS[combo]
    lists = []
    for level in levels:
        names = [F.when(F.size(f"d_{level}") > 0, F.col(f"d_{level}")).otherwise(F.array(F.lit("NONE"))) if s == "d" else F.col(f"{s}_{level}") for s in parts]
        lists.append(F.struct(F.lit(level).alias("level"), *[x.alias(s) for s, x in zip(parts, names, strict=True)]))
    rows = resolved.select(*by, "productive", *_measures(resolved), F.explode(F.array(*lists)).alias("x"))
    n = F.lit(1)
    for s in parts:
        n = n * F.size(f"x.{s}")
    out = rows.select("*", n.alias("n")).where("n > 0")
    head = F.lit(True)
    for s in parts:
        out = out.select("*", F.posexplode(f"x.{s}").alias(f"_p{s}", f"_{s}"))
        head &= F.col(f"_p{s}") == 0
    named = out.select(*by, "productive", "rows", "w", F.lit(combo).alias("combo"), "x.level", "n", head.alias("head"), F.concat_ws("|", *[f"_{s}" for s in parts]).alias("name"))
    return finished(_parts(named, [*by, "combo", "level"]), [*by, "combo", "level"], totals)


def with_frequency(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Adds each count's share of the total of its (keys, level, mode, productive); 0 where that is 0. Totals are
    exact where ``counts`` come with their ``totals``, which are dropped; else the counts themselves are added."""
    w = Window.partitionBy(*keys, "level", "mode", "productive")
    for m in _MEASURES:
        of = m.replace("count", "total")
        total = F.sum(of if of in counts.columns else m).over(w)
        counts = counts.withColumn(m.replace("count", "frequency"), F.when(total == 0, 0.0).otherwise(F.col(m) / total)).drop(of)
    return counts
