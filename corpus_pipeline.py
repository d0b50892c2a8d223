"""The corpus pipeline: quality classifier, line dedup, MinHash near-dedup, secret scan, packing.

Each stage takes (spark, docs, sf_dir) and works on every row its predecessor kept. All but the last
return the columns of ``documents``; ``n_chars`` follows the text. The last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lymphoframe.llm import lines, minhash, packing, quality, secrets
from lymphoframe.llm.common import cut, scratch, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("bigint")).select(COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier rejects go. Texts without words are kept with the class
    prior; repeated rows share their fate."""
    return _documents(quality.score(docs.select(COLUMNS), quality.fit(docs)).where("kept"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of two lines or more go from the texts; no document goes. Null texts
    and null doc_ids stay as they are."""
    return _documents(lines.dedup(docs.select(COLUMNS)))


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (similarity 0.8, five-word shingles) one row stays, of the smallest
    doc_id. Rows are told apart by doc_id and text; rows without words all stay."""
    return _documents(minhash.keep_one(docs.select(COLUMNS), percent=80))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are written over in the texts; no document goes."""
    return _documents(secrets.redact(docs.select(COLUMNS)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of sequences of at most 1024 tokens; a null text is one 0, an empty table has none."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("minhash near-dedup", minhash_stage),
    ("secret scan", secret_stage),
    ("packing", packing_stage),
]

#: SQL can't express the stages; tests/llm compares each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark):
            docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}", keep=True)
    return docs
