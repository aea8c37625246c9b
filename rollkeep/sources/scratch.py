"""Results that several steps read: written once to the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Without one, a temporary folder if Spark runs on this machine alone; else an error."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="spark-")


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """The rows of df, written as Parquet and read again: computed once, safe against lost executors, read by column and partition."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
