"""Gene usage over a stream of rearrangement rows: the batch operator's own aggregate, kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lymphoframe.functions.calls import resolve
from lymphoframe.operators.segments import finished, usage_parts

KEYS = ["repertoire_id", "field", "level"]
PART = [*KEYS, "productive", "name", "n"]


def usage_stream(rows: DataFrame, germline: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """``rows`` is a streaming frame of rearrangements. Each batch writes the integer sums that it changed
    to ``path``/batch=N (a repeated batch writes the same folder again); state holds one row per
    repertoire, field, level, name and number of names, which the germline set and its calls bound."""

    def put(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return usage_parts(resolve(rows, germline)).writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).start()


def usage_now(spark: SparkSession, path: str) -> DataFrame:
    """The counts so far: of each sum the row of its last batch."""
    last = F.max_by(F.struct("rows", "w", "head_rows", "head_w"), "batch").alias("c")
    return finished(spark.read.parquet(path).groupBy(*PART).agg(last).select(*PART, "c.*"), KEYS)
