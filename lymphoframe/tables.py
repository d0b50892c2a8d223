"""Tables written between the steps of a query, in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a local folder, deleted at exit, only where it is unset."""
    found = spark.sparkContext.getConf().get(_SETTING) or spark.conf.get(_SETTING, None)
    if not found:
        local = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        atexit.register(shutil.rmtree, local, True)
        found = f"file://{local}"
        spark.conf.set(_SETTING, found)
    return found


def written(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """``df`` written as Parquet (in folders by ``partition_by``) and read back: what follows reads it as often as it
    likes, and neither computes it again nor depends on the executors that made it."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` made and that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(table._folder)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(scan: DataFrame) -> DataFrame:
    """A scan of fewer splits than the cluster has cores (one row group, a compressed text) dealt evenly to all of
    them, so that what is computed row by row keeps them busy; any other scan as it is."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
