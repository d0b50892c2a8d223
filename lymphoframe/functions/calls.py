"""Segment calls: comma lists of germline labels, resolved once per row into arrays of names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lymphoframe.schema import LEVELS, SEGMENTS


def germline_names(germline: DataFrame) -> DataFrame:
    """(label, allele, gene, subgroup). Gene = locus, type and designation joined; a missing subgroup falls back to the gene."""
    head = F.concat("locus", "sequence_type")
    gene = F.concat(head, "gene_designation")
    return germline.select("label", F.col("label").alias("allele"), gene.alias("gene"), F.when(F.col("subgroup_designation").isNull(), gene).otherwise(F.concat(head, "subgroup_designation")).alias("subgroup"))


#: Labels that the one-row dictionary may hold (a germline set has some hundred); beyond, ``resolve_by_join``.
MOST_LABELS = 5_000


def dictionary(germline: DataFrame) -> DataFrame:
    """One row, one map: label -> names, small enough to broadcast. The plan itself checks the size."""
    entries = F.map_from_entries(F.collect_list(F.struct("label", F.struct(*LEVELS))))
    checked = F.when(F.count("*") <= MOST_LABELS, entries).otherwise(F.raise_error(F.lit(f"more than {MOST_LABELS} germline labels: use resolve_by_join")))
    return germline_names(germline).agg(checked.alias("_names"))


def resolve(rearrangements: DataFrame, germline: DataFrame, segments: tuple[str, ...] = SEGMENTS) -> DataFrame:
    """Adds ``{segment}_{level}`` arrays: distinct names in the call's order, unknown labels left out."""
    out = rearrangements.crossJoin(F.broadcast(dictionary(germline)))
    for s in segments:
        labels = F.split(F.coalesce(f"{s}_call", F.lit("")), ",")
        out = out.withColumn(f"_{s}", F.filter(F.transform(labels, lambda x: F.try_element_at("_names", x)), lambda h: h.isNotNull()))
    for s in segments:
        for level in LEVELS:
            out = out.withColumn(f"{s}_{level}", F.array_distinct(F.transform(f"_{s}", _field(level))))
    return out.drop("_names", *[f"_{s}" for s in segments])


def resolve_by_join(rearrangements: DataFrame, germline: DataFrame, segments: tuple[str, ...] = SEGMENTS) -> DataFrame:
    """As ``resolve``, for dictionaries of any size: the distinct calls are resolved by a join and
    joined back on the call. Nothing is broadcast but what Spark itself finds small."""
    calls = None
    for s in segments:
        one = rearrangements.select(F.col(f"{s}_call").alias("_call")).distinct()
        calls = one if calls is None else calls.unionAll(one)
    labels = calls.distinct().select("_call", F.posexplode(F.split("_call", ",")).alias("_at", "label"))
    hits = labels.join(germline_names(germline), "label").groupBy("_call").agg(F.array_sort(F.collect_list(F.struct("_at", *LEVELS))).alias("_hits"))
    out = rearrangements
    for s in segments:
        mine = hits.select(F.col("_call").alias(f"{s}_call"), *[F.array_distinct(F.transform("_hits", _field(level))).alias(f"{s}_{level}") for level in LEVELS])
        out = out.join(mine, f"{s}_call", "left")
        for level in LEVELS:
            out = out.withColumn(f"{s}_{level}", F.coalesce(f"{s}_{level}", F.array().cast("array<string>")))
    return out.select(*rearrangements.columns, *[f"{s}_{level}" for s in segments for level in LEVELS])


def _field(level: str):
    return lambda hit: hit[level]


def at_level(segment: str, level: str) -> Column:
    """The call at a level as one comma-joined string."""
    return F.array_join(f"{segment}_{level}", ",")


def weight() -> Column:
    return F.coalesce("duplicate_count", F.lit(1))


def is_productive() -> Column:
    return F.coalesce("productive", F.lit(False))
