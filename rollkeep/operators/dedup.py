"""One record for each stable reference, within a list and across lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollkeep.schemas import SOURCE_LISTS


def dedup_within(records: DataFrame, key: str = "fixed_ref", order: str = "pos", by: tuple[str, ...] = ()) -> DataFrame:
    """The first record of each reference, in source order; `by` keeps lists or snapshots apart."""
    w = Window.partitionBy(*by, key).orderBy(order)
    return records.withColumn("rn_", F.row_number().over(w)).where("rn_ = 1").drop("rn_")


def dedup_across(records: DataFrame, lists: list[str], key: str = "fixed_ref", order: str = "pos") -> DataFrame:
    """The distinct union of the given lists: the earlier list wins, then the earlier record. Others are left out."""
    rank = F.array_position(F.array(*[F.lit(x) for x in lists]), F.col("source_list"))
    rows = records.where(F.col("source_list").isin(*lists)).withColumn("rank_", rank)
    w = Window.partitionBy(key).orderBy("rank_", order)
    return rows.withColumn("rn_", F.row_number().over(w)).where("rn_ = 1").drop("rn_", "rank_")


def combine_counts(results: DataFrame) -> DataFrame:
    """One row of several lists' result rows (source_list, status, out_of_scope_count): counts summed, the first failure in list order."""
    rank = F.array_position(F.array(*[F.lit(x) for x in SOURCE_LISTS]), F.col("source_list"))
    failed = F.when(F.col("status") == "FAILED", F.col("source_list"))
    out = results.agg(F.sum("out_of_scope_count").alias("out_of_scope_count"), F.min_by(failed, F.when(failed.isNotNull(), rank)).alias("failed_list"))
    return out.select("out_of_scope_count", F.lit(None).cast("long").alias("record_count"), F.when(F.col("failed_list").isNull(), "BUILT").otherwise("FAILED").alias("status"), "failed_list")


def list_overlap(left: DataFrame, right: DataFrame, key: str = "fixed_ref") -> DataFrame:
    """shared, only_left and only_right: distinct references of two lists, from one grouping."""
    both = left.select(key).distinct().withColumn("l", F.lit(1)).unionByName(right.select(key).distinct().withColumn("l", F.lit(2)))
    sides = both.groupBy(key).agg(F.sum("l").alias("s"))
    n = lambda v: F.count_if(F.col("s") == v)
    return sides.agg(n(3).alias("shared"), n(1).alias("only_left"), n(2).alias("only_right"))
