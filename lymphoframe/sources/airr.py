"""Readers of rearrangement files, repertoire metadata, repertoire groups and germline sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lymphoframe.schema import REARRANGEMENT

#: How a boolean is written in rearrangement files.
TRUE, FALSE = ("T", "t", "true", "TRUE", "True", "1"), ("F", "f", "false", "FALSE", "False", "0")


def rearrangement_paths(repertoires: list[str], folder: str, stage: str | None = None, files: list[str] | None = None) -> list[str]:
    """The listed files, or one file per repertoire (with its processing stage in the name)."""
    if files:
        return [f if "/" in f else f"{folder}/{f}" for f in files]
    return [f"{folder}/{r}.{stage}.airr.tsv" if stage else f"{folder}/{r}.airr.tsv" for r in repertoires]


def input_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """The files behind the paths in input order: paths as listed, the files of a folder or pattern by name. No
    job is run; a path that leads nowhere is an error."""
    plain = lambda uri: spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()
    return [plain(f) for path in paths for f in sorted(spark.read.text(path).inputFiles())]


def header(spark: SparkSession, file: str) -> list[str]:
    """The column names of a tab-separated file (compressed too): its first line, read through the file system, no job."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    names: list[str] = []
    for k, name in enumerate((line or "").lstrip("\ufeff").split("\t") if line else []):
        names.append(f"{name}_{k}" if not name or name.lower() in {n.lower() for n in names} else name)
    return names


def read_rearrangements(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Tab-separated rows (``.gz`` too): known columns typed, others as text, plus ``source_file`` and
    ``ord``, the input order. A missing file fails when the plan is made.

    ``ord`` sorts rows as one pass over the files would meet them: the file's rank in the input, where the
    row's split begins in it, and the row's place in the split; however Spark packs splits into tasks.
    Files may differ in their columns: those with one header are read at once, and the few headers
    united by name, a missing column is null; a file without a header has no rows. Empty text stays
    empty; an empty number or boolean is null."""
    form = {"sep": "\t", "header": True, "inferSchema": False, "nullValue": None, "emptyValue": "", "quote": "", "enforceSchema": True}
    files = input_files(spark, [paths] if isinstance(paths, str) else paths)
    ranks = F.broadcast(spark.createDataFrame(list(zip(files, range(len(files)), strict=True)), "_file string, _rank int"))
    headers: dict[tuple[str, ...], list[str]] = {}
    for f in files:
        headers.setdefault(tuple(header(spark, f)), []).append(f)
    headers.pop((), None)
    out = None
    for columns, alike in headers.items():
        rows = spark.read.csv(alike, schema=T.StructType([T.StructField(c, T.StringType()) for c in columns]), **form)
        placed = rows.select(*[F.col(f"`{c}`") for c in columns], F.input_file_name().alias("source_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))
        out = placed if out is None else out.unionByName(placed, allowMissingColumns=True)
    if out is None:
        out = spark.createDataFrame([], "source_file string, _block long, _row long")
    typed = []
    for name in [c for c in out.columns if c not in ("source_file", "_block", "_row")]:
        kind = REARRANGEMENT[name].dataType if name in REARRANGEMENT.names else T.StringType()
        c = F.col(f"`{name}`")
        if isinstance(kind, T.BooleanType):
            c = F.when(c.isin(*TRUE), True).when(c.isin(*FALSE), False)
        elif isinstance(kind, T.LongType):
            c = c.try_cast("bigint")
        elif name in REARRANGEMENT.names:
            c = F.coalesce(c, F.lit(""))
            c = F.when(c == "", None).otherwise(c) if name in ("repertoire_id", "clone_id") else c
        typed.append(c.alias(name))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in REARRANGEMENT.fields if f.name not in out.columns]
    # file names come as URIs of two spellings (file:/a and file:///a, escaped or not)
    plain = F.url_decode(F.regexp_replace(F.regexp_replace("source_file", "\\+", "%2B"), "^([a-z0-9]+:)///", "$1/"))
    ranked = out.withColumn("_file", plain).join(ranks, "_file", "left")
    return ranked.select(*typed, *missing, "source_file", F.struct(F.col("_rank").alias("file"), F.col("_block").alias("block"), F.col("_row").alias("row")).alias("ord"))


def read_repertoires(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, multiLine=True).select(F.explode("Repertoire").alias("r")).select("r.*")


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """repertoire_group_id, repertoire_id: the members."""
    groups = spark.read.json(path, multiLine=True).select(F.explode("RepertoireGroup").alias("g"))
    return groups.select("g.repertoire_group_id", F.explode("g.repertoires").alias("r")).select("repertoire_group_id", "r.repertoire_id")


def read_group_filters(spark: SparkSession, path: str) -> dict[str, dict]:
    """Group id -> row filter; a configuration file, read whole."""
    import json

    text = "".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
    return {g["repertoire_group_id"]: g["filter"]["Rearrangement"] for g in json.loads(text)["RepertoireGroup"] if (g.get("filter") or {}).get("Rearrangement")}


def read_germline(spark: SparkSession, path: str) -> DataFrame:
    """label, locus, sequence_type, gene_designation, subgroup_designation; of equal labels the last counts."""
    alleles = spark.read.json(path, multiLine=True).select(F.posexplode("GermlineSet").alias("i", "s")).select("i", F.posexplode("s.allele_descriptions").alias("k", "a"))
    fields = ["label", "locus", "sequence_type", "gene_designation", "subgroup_designation"]
    last = Window.partitionBy("a.label").orderBy(F.desc("i"), F.desc("k"))
    return alleles.withColumn("_n", F.row_number().over(last)).where("_n = 1").select(*[F.col(f"a.{f}").cast("string").alias(f) for f in fields])
