"""Reports: Parquet as the scalable form, tab-separated files for small summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lymphoframe.operators.sharing import unit_ids
from lymphoframe.schema import AMINO_ACIDS, NUCLEOTIDES
from lymphoframe.tables import partitions


def write_parquet(df: DataFrame, path: str, *partition_by: str) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_tsv(df: DataFrame, path: str, order: list[str] | None = None, parts: int | None = None) -> None:
    """A report as text, a header in each part: nested columns are written as JSON.

    With an ``order`` the rows are dealt to ranges of it and sorted there, so the parts, in the order of
    their names, are the report in its order, and no task has to hold it: a small report is one part,
    a large one as many as its size asks for (or ``parts``)."""
    flat = df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes])
    if order and parts:
        flat = flat.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    elif order:
        flat = flat.orderBy(*order)
    flat.write.mode("overwrite").csv(path, sep="\t", header=True)


def per_key_tsv(df: DataFrame, path: str, key: str, order: list[str] | None = None) -> None:
    """One folder per key value (a report per repertoire or group), its parts in the order of the other keys: a key
    with very many rows has many parts."""
    rest = [c for c in (order or []) if c != key]
    ranged = df.repartitionByRange(partitions(df.sparkSession), key, *rest).sortWithinPartitions(key, *rest)
    ranged.write.mode("overwrite").partitionBy(key).csv(path, sep="\t", header=True)


def wide_lengths(dense: DataFrame, most: int, by: str = "repertoire_id", value: str = "count") -> DataFrame:
    """A row per repertoire: total, avg and a column per length; ``value`` is count or relative. Cells
    past its own largest length stay empty; avg is 0 where the total is."""
    total = F.sum(value)
    avg = F.when(total == 0, 0.0).otherwise(F.sum(F.col("length") * F.col(value)) / total)
    sums = dense.groupBy(by, "productive").agg(total.alias("total"), avg.alias("avg"))
    return sums.join(dense.groupBy(by, "productive").pivot("length", list(range(most + 1))).agg(F.first(value)), [by, "productive"])


def wide_matrix(matrix: DataFrame, value: str, ids: list[str]) -> DataFrame:
    """The square report of repertoire pairs; ``ids`` names the columns."""
    return matrix.groupBy("level", "repertoire_id_a").pivot("repertoire_id_b", ids).agg(F.first(value))


def wide_letters(distribution: DataFrame, letters: str, *by: str) -> DataFrame:
    return distribution.groupBy(*by, "productive", "length", "position").pivot("letter", list(letters)).agg(F.first("count"))


def wide_reports(results: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The wide forms of a run's tables: letters by column, square matrices of repertoire pairs (their ids, a
    dimension, reach the driver)."""
    out = {}
    for name, df in results.items():
        if name.startswith("distribution_"):
            out[f"{name}_wide"] = wide_letters(df, AMINO_ACIDS if name.startswith("distribution_aa") else NUCLEOTIDES, "repertoire_group_id" if "repertoire_group_id" in df.columns else "repertoire_id")
        elif name == "share_matrix":
            ids = unit_ids(df.withColumnRenamed("repertoire_id_a", "repertoire_id"), "repertoire_id")
            out["share_matrix_shared_wide"], out["share_matrix_diff_wide"] = wide_matrix(df, "n_shared", ids), wide_matrix(df, "n_diff", ids)
    return out


#: Columns that say what a row is about, in the order of the reports.
KEYS = ("repertoire_group_id", "repertoire_id", "repertoire_group_id_a", "repertoire_group_id_b", "repertoire_id_a", "repertoire_id_b", "level", "field", "combo", "scope", "part", "region_class", "mode", "productive",
        "gene_key", "cdr3", "share_level", "share_level_a", "share_level_b", "name", "length", "position", "letter", "clone_id", "segment")
#: Reports that come in an order of their own.
ORDERED = ("group_detail", "group_diff")


def write_reports(results: dict[str, DataFrame], folder: str, stage: str | None = None, form: str = "parquet", apart: bool = False) -> list[str]:
    """Every table of a run in a folder of its own: ``{name}[.{stage}]``. ``form`` is parquet (for any
    size, by repertoire or group where there is one; filtered rows by both) or tsv (in the order of their
    keys, with the wide forms of letters, matrices and lengths; ``apart``: in a folder for each group or repertoire)."""
    written = []
    for name, df in {**results, **(wide_reports(results) if form == "tsv" else {})}.items():
        path = f"{folder}/{name}.{stage}" if stage else f"{folder}/{name}"
        if form == "tsv":
            keys = [c for c in KEYS if c in df.columns]
            if apart and keys and keys[0] in ("repertoire_group_id", "repertoire_id") and name not in ORDERED:
                per_key_tsv(df, path, keys[0], keys)
            else:
                write_tsv(df, path, None if name in ORDERED else keys or None)
        else:
            ids = [c for c in ("repertoire_group_id", "repertoire_id") if c in df.columns]
            write_parquet(df, path, *(ids if name == "filtered" else ids[:1]))
        written.append(path)
    return written + (write_length_reports(results, folder) if form == "tsv" else [])


def write_length_reports(results: dict[str, DataFrame], folder: str, most: int | None = None) -> list[str]:
    """The wide length tables of each group: counts and frequencies, a row per repertoire; columns up to the
    length ``most`` (the largest that occurs, where none is given)."""
    written = []
    for name, df in results.items():
        if name.startswith("length_") and name.endswith("_group_repertoires"):
            if most is None:
                most = df.agg(F.max("length")).first()[0] or 0
            for value in ("count", "relative"):
                path = f"{folder}/{name}_{value}"
                keyed = df.withColumn("_key", F.struct("repertoire_group_id", "repertoire_id"))
                wide = wide_lengths(keyed, most, "_key", value).select("_key.*", "productive", "total", "avg", *map(str, range(most + 1)))
                write_tsv(wide, path, ["repertoire_group_id", "repertoire_id", "productive"])
                written.append(path)
    return written
