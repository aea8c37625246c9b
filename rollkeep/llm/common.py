"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Prefix of the columns that operators add for their own use, so that extra input columns cannot clash.
OWN = "__rk_"
#: Rows of a small result (numbers and hashes, no texts) in one partition, about.
ROWS = 1 << 16


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in spark.checkpoint.dir; set a temporary one only where none is set (tests, one machine)."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(spark))


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Without one, a temporary folder if Spark runs on this machine alone; else an error."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="spark-")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of df, written to the shared checkpoint folder; later reads survive lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def fit(df: DataFrame, rows: int) -> DataFrame:
    """df, whose plan has no shuffle, in no more partitions than so many rows need; what stands in one is grouped and joined without a shuffle."""
    parts = max(1, -(-rows // ROWS))
    return df.coalesce(parts) if parts == 1 or 2 * parts <= df.rdd.getNumPartitions() else df


def fitted(df: DataFrame, having: str = "true") -> tuple[DataFrame, int]:
    """The rows of df, checkpointed, in no more partitions than they need, and how many they are or how many have a condition.

    Rows are counted while they are written. A few rows in all partitions of a session would make every later step run
    as many tasks, and the driver plans, notes and adds up every task of every step.
    """
    seen = Observation()
    kept = checkpointed(df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.expr(having)).alias("having")))
    return fit(kept, seen.get["rows"]), seen.get["having"]


def held_out(doc_id: Column | str) -> Column:
    """True for the quarter of the documents that no classifier may learn from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2 if isinstance(doc_id, str) else F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a worker holds few texts and results at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def set_aside(df: DataFrame, names: list[str]) -> DataFrame:
    """df with its columns of these names renamed, so that an operator may add its own; bring_back undoes it."""
    return df.withColumnsRenamed({n: f"{OWN}aside_{n}" for n in names if n in df.columns})


def bring_back(df: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns of what came from set_aside, under their own names."""
    return df.select([F.col(f"`{OWN}aside_{c}`").alias(c) if f"{OWN}aside_{c}" in df.columns else F.col(f"`{c}`") for c in columns])


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
