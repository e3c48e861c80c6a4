"""The folder for tables and checkpoints between jobs, which driver and executors must share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Taken only where one machine runs all and the session names no folder, as in tests.
LOCAL = "file:///tmp/checkpoints"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. A cluster without it is an error: its executors would each write their own disk."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
    return LOCAL


def _hadoop(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared folder; what is left there goes as the driver ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    hadoop, files = _hadoop(spark, path)
    files.deleteOnExit(hadoop)
    return path


def kept(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written to the shared folder and read again, so that plans which use them many times work them out once."""
    path = fresh_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no later plan reads."""
    hadoop, files = _hadoop(spark, path)
    files.delete(hadoop, True)
