"""Junction length histograms and positional letter distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lymphoframe.functions.calls import is_productive, weight
from lymphoframe.schema import AMINO_ACIDS, NUCLEOTIDES


def _split_productive(rows: DataFrame) -> DataFrame:
    return rows.withColumn("productive", F.explode(F.when(is_productive(), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))


def length_column(kind: str) -> Column:
    """``aa``: a missing length is counted from the letters; ``nt``: a row without a length is left out."""
    return F.coalesce("junction_aa_length", F.length("junction_aa")).cast("bigint") if kind == "aa" else F.col("junction_length")


def with_length(rows: DataFrame) -> DataFrame:
    """Rows whose missing ``junction_aa_length`` is counted from the letters, for filters on it."""
    return rows.withColumn("junction_aa_length", length_column("aa"))


def lengths(rows: DataFrame, kind: str, by: tuple[str, ...] = ("repertoire_id",), weighted: bool = True) -> DataFrame:
    """by, productive, length, count. Length 0 is never counted."""
    measured = _split_productive(rows.select(*by, "productive", weight().cast("double").alias("w"), length_column(kind).alias("length")).where("length > 0"))
    return measured.groupBy(*by, "productive", "length").agg((F.sum("w") if weighted else F.count("*").cast("double")).alias("count"))


def lengths_of(tally: DataFrame, kind: str, by: tuple[str, ...] = ("repertoire_id",), weighted: bool = True) -> DataFrame:
    """As ``lengths``, of a tally with length_aa, length_nt, rows and weights."""
    measured = tally.select(*by, "productive", F.col("weights" if weighted else "rows").cast("double").alias("w"), F.col(f"length_{kind}").cast("bigint").alias("length")).where("length > 0")
    return _split_productive(measured).groupBy(*by, "productive", "length").agg(F.sum("w").alias("count"))


def dense(histogram: DataFrame, keys: list[str]) -> DataFrame:
    """All lengths from 0 to each key's largest, 0 where nothing was counted."""
    grid = histogram.groupBy(*keys).agg(F.max("length").alias("most")).select(*keys, F.explode(F.sequence(F.lit(0).cast("bigint"), "most")).alias("length"))
    return grid.join(histogram, [*keys, "length"], "left").select(*keys, "length", F.coalesce("count", F.lit(0.0)).alias("count"))


def relative(histogram: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``relative``: share of the key's total (a total of 0 counts as 1)."""
    total = F.sum("count").over(Window.partitionBy(*keys))
    return histogram.withColumn("relative", F.col("count") / F.when(total == 0, 1.0).otherwise(total))


def length_stats(histogram: DataFrame, keys: list[str]) -> DataFrame:
    """total and weighted mean length of each key."""
    total = F.sum("count")
    return histogram.groupBy(*keys).agg(total.alias("total"), F.when(total == 0, 0.0).otherwise(F.sum(F.col("length") * F.col("count")) / total).alias("avg"))


def distribution(rows: DataFrame, kind: str, by: tuple[str, ...] = ("repertoire_id",), strict_alphabet: bool = False) -> DataFrame:
    """by, productive, length, position, letter, count: long form, every letter of the alphabet at
    every position that occurs, 0 where it doesn't.

    A junction with a letter outside the amino acid list is left out whole; nucleotide junctions are
    tested against the same list (``strict_alphabet``: against ACGT) and only ACGT are reported. ``rows``
    may be a tally: a column ``rows`` says for how many each of its rows stands."""
    column, letters = ("junction_aa", AMINO_ACIDS) if kind == "aa" else ("junction", NUCLEOTIDES)
    allowed = NUCLEOTIDES if strict_alphabet and kind == "nt" else AMINO_ACIDS
    stands = F.col("rows") if "rows" in rows.columns else F.lit(1).cast("bigint")
    sound = _split_productive(rows.select(*by, "productive", stands.alias("rows"), F.col(column).alias("s")).where(F.col("s").rlike(f"^[{allowed}]+$")))
    spelled = sound.select(*by, "productive", "rows", F.length("s").alias("length"), F.posexplode(F.split("s", "")).alias("position", "letter"))
    keys = [*by, "productive", "length", "position"]
    counted = spelled.groupBy(*keys).agg(*[F.sum(F.when(F.col("letter") == x, F.col("rows")).otherwise(0)).alias(x) for x in letters])
    return counted.select(*keys, F.expr("stack({}, {}) AS (letter, count)".format(len(letters), ", ".join(f"'{x}', {x}" for x in letters))))


def relative_distribution(counts: DataFrame, keys: list[str]) -> DataFrame:
    total = F.sum("count").over(Window.partitionBy(*keys, "length", "position"))
    return counts.withColumn("relative", F.when(total == 0, 0.0).otherwise(F.col("count") / total))
