"""Line dedup: repeated content-defined chunks of lines removed. SQL functions only.

A rolling hash over every ``least`` adjacent lines (two: each line with the next one) is counted over all
documents. A chunk is a longest run of lines whose rolling hashes occur more than once: it begins and
ends where its own lines stop being shared, so the boundaries follow the content and not its place in
a text, and lines put in front of a passage shift nothing. What the hashes nominate is decided on its
bytes. Of a chunk go the lines that also lie, in a run of ``least`` lines or more, at an earlier place
(a smaller doc_id, or before it in the same document, without a common line): every later copy of
every such run goes whole, wherever it begins or ends; the first place of each line stays.

``chunks`` cuts a text by the rolling hash alone (over the last ``window`` lines, on one residue of
``divisor``), for texts that are compared without the rest of the corpus; chunks of two lines or more
that repeat are among the runs above.

Defined results: null text has no lines and stays null; an empty text is one empty line; rows
that share doc_id and text are one document (they keep or lose the same lines), those that share
only the doc_id are documents of their own; a null doc_id never counts as a place and its row
keeps its text; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lymphoframe.llm.common import cut, let, table

WINDOW = 2
DIVISOR = 4
LEAST_LINES = 2


def chunks(text: Column, window: int = WINDOW, divisor: int = DIVISOR) -> Column:
    """array<struct<n,body>>: number of lines and text of each content-defined chunk, in order."""

    def ends(lines):
        def of(h):
            def boundary(i):
                roll = F.xxhash64(*[F.coalesce(F.get(h, i - k), F.lit(0)) for k in range(window)])
                return F.pmod(roll, F.lit(divisor)) == 0

            last = F.size(lines) - 1
            inner = F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | boundary(i))
            return let(inner, lambda e: F.transform(e, lambda stop, k: cutout(lines, F.when(k == 0, F.lit(0)).otherwise(F.get(e, k - 1) + 1), stop)))

        return let(F.transform(lines, lambda x: F.xxhash64(x)), of)

    def cutout(lines, first, stop):
        n = stop - first + 1
        return F.struct(n.alias("n"), F.array_join(F.slice(lines, first + 1, n), "\n").alias("body"))

    return let(F.split(text, "\n", -1), ends)


def _grams(text: Column, least: int) -> Column:
    """array<bigint>: the hash of every ``least`` adjacent lines, by the first of them."""

    def of(lines):
        gram = lambda i: F.xxhash64(_joined(lines, i, least))
        return F.when(F.size(lines) >= least, F.transform(F.sequence(F.lit(0), F.size(lines) - least), gram))

    return let(F.split(text, "\n", -1), of)


def _joined(lines: Column, first: Column, least: int) -> Column:
    return F.array_join(F.slice(lines, first + 1, least), "\n")


def _copy() -> Column:
    """Tells apart rows that share a doc_id but not the text."""
    return F.xxhash64("text").alias("copy")


def repeated_places(docs: DataFrame, least: int = LEAST_LINES) -> DataFrame:
    """(doc_id, copy, at) of every ``least`` adjacent lines that also lie at an earlier place, without a
    common line. Every table that meets hot lines in a join is written first, so that both sides
    are plain exchanges and a skewed key is split."""
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")
    places = rows.select("doc_id", _copy(), F.posexplode(_grams(F.col("text"), least)).alias("at", "hash"))
    nominated = cut(places.groupBy("hash").count().where("count > 1").select("hash"), "line-hashes")
    hits = cut(places.join(nominated, "hash", "left_semi"), "line-places")
    # the bytes of what the hashes nominate: texts are read again only for documents that have some
    ats = hits.groupBy("doc_id", "copy").agg(F.collect_set("at").alias("ats"))
    lines = F.split("text", "\n", -1)
    bodies = lambda ls: F.transform("ats", lambda i: F.struct(i.alias("at"), _joined(ls, i, least).alias("body")))
    found = rows.withColumn("copy", _copy()).join(ats, ["doc_id", "copy"]).select("doc_id", "copy", F.explode(let(lines, bodies)).alias("p"))
    meets = cut(found.select("doc_id", "copy", "p.at", F.xxhash64("p.body").alias("hash"), "p.body"), "line-bodies")
    place = F.struct("doc_id", "copy", "at")
    firsts = cut(meets.groupBy("hash", "body").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("hash", "body", "first"), "line-repeats")
    met = meets.join(firsts, ["hash", "body"])
    elsewhere = (F.col("doc_id") != F.col("first.doc_id")) | (F.col("copy") != F.col("first.copy"))
    return met.where(elsewhere | (F.col("at") >= F.col("first.at") + least)).select("doc_id", "copy", "at")


def _without(lines: Column, gone: Column, least: int) -> Column:
    """The lines outside the runs of ``least`` lines that begin at ``gone`` (sorted)."""

    def between(k):
        first = F.when(k == 0, F.lit(0)).otherwise(F.get(gone, k - 1) + least)
        return F.slice(lines, first + 1, F.greatest(F.coalesce(F.get(gone, k), F.size(lines)) - first, F.lit(0)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), between))


def dedup(docs: DataFrame, least: int = LEAST_LINES) -> DataFrame:
    """``docs`` with the repeated runs taken out of ``text``, plus ``n_lines`` and ``n_removed``."""
    gone = repeated_places(docs, least).groupBy(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy")).agg(F.sort_array(F.collect_set("at")).alias("_gone"))
    joined = docs.join(gone, (F.col("doc_id") == F.col("_id")) & (_copy() == F.col("_copy")), "left")
    lines = F.split("text", "\n", -1)
    kept = let(lines, lambda ls: _without(ls, F.col("_gone"), least))
    return (joined.withColumn("_kept", F.when(F.col("_gone").isNotNull(), kept))
            .withColumn("n_lines", F.coalesce(F.size(lines), F.lit(0)).cast("bigint"))
            .withColumn("n_removed", F.when(F.col("_gone").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("_kept")).cast("bigint"))
            .withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join("_kept", "\n")))
            .drop("_id", "_copy", "_gone", "_kept"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.col("n_lines")).alias("n_lines"), "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
