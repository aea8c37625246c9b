"""Differences between versions, and statistics of a version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def record_hash(columns: list[str]) -> Column:
    """SHA-256 of the columns' JSON; null fields are left out of it."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def diff(old: DataFrame, new: DataFrame, key: str = "fixed_ref", columns: list[str] | None = None) -> DataFrame:
    """(key, change): ADDED, REMOVED or MODIFIED between two versions; equal records have no row. Keys are unique in each."""
    columns = columns or sorted(c for c in old.columns if c != key)
    a = old.select(key, record_hash(columns).alias("a"))
    b = new.select(key, record_hash(columns).alias("b"))
    rows = a.join(b, key, "full_outer")
    change = F.when(F.col("a").isNull(), "ADDED").when(F.col("b").isNull(), "REMOVED").when(F.col("a") != F.col("b"), "MODIFIED")
    return rows.withColumn("change", change).where("change is not null").select(key, "change")


def ids_gone(old: DataFrame, new: DataFrame, key: str = "fixed_ref") -> DataFrame:
    return old.select(key).exceptAll(new.select(key))


def ids_shared(old: DataFrame, new: DataFrame, key: str = "fixed_ref") -> DataFrame:
    return old.select(key).intersect(new.select(key))


def element_statistics(rows: DataFrame, sizes: list[str]) -> DataFrame:
    """(element, total, mean, most, without) of columns that hold element counts, one row for each; one pass."""
    one = rows.agg(*[f for c in sizes for f in (F.sum(c).alias(f"{c}_total"), F.avg(c).alias(f"{c}_mean"), F.max(c).alias(f"{c}_most"), F.count_if(F.col(c) == 0).alias(f"{c}_without"))])
    parts = F.array(*[F.struct(F.lit(c).alias("element"), F.col(f"{c}_total").cast("long").alias("total"), F.col(f"{c}_mean").alias("mean"), F.col(f"{c}_most").cast("long").alias("most"), F.col(f"{c}_without").alias("without")) for c in sizes])
    return one.select(F.explode(parts).alias("x")).select("x.*")


def record_statistics(records: DataFrame) -> DataFrame:
    """element_statistics of the multi-valued fields of records."""
    fields = ["aliases", "addresses", "documents", "nationalities", "citizenships", "birth_dates", "sanction_programs", "relationships", "features"]
    return element_statistics(records.select(*[F.size(c).alias(c) for c in fields]), fields)


def presence(records: DataFrame, fields: list[str]) -> DataFrame:
    """(field, present, share): records that have each field."""
    there = {c: F.col(c).isNotNull() for c in fields}
    one = records.agg(F.count(F.lit(1)).alias("n_"), *[F.count_if(e).alias(c) for c, e in there.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("present"), (F.col(c) / F.col("n_")).alias("share")) for c in fields])).alias("x")).select("x.*")


def incomplete_birth_dates(records: DataFrame) -> DataFrame:
    """(dates, incomplete): birth dates, and those without a month or a day."""
    d = records.select(F.explode("birth_dates").alias("d"))
    return d.agg(F.count(F.lit(1)).alias("dates"), F.count_if(F.col("d.period").isNull() & (F.col("d.month").isNull() | F.col("d.day").isNull())).alias("incomplete"))


def by_program(records: DataFrame) -> DataFrame:
    return records.select(F.explode("sanction_programs").alias("program")).groupBy("program").agg(F.count(F.lit(1)).alias("records"))


def by_type(records: DataFrame) -> DataFrame:
    return records.groupBy("entity_type").agg(F.count(F.lit(1)).alias("records"))


def diagnostic_counts(diagnostics: DataFrame) -> DataFrame:
    return diagnostics.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
