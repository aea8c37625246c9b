"""Landed files: raw bytes, delimited records, JSON lines, and a write-once landing folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The columns of the delimited party file, and its mark for an empty field.
CSV_COLUMNS = ("ent_num", "sdn_name", "sdn_type", "program", "title", "call_sign", "vess_type", "tonnage", "grt", "vess_flag", "vess_owner", "remarks")
CSV_EMPTY = "-0-"


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """path, length, digest and content of each landed file."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("digest"), "content")


def starts_record(line: Column) -> Column:
    """Whether a line begins a delimited record: with a number and a comma; other lines go on the record before."""
    return line.rlike(r"^\d+,")


def csv_count(spark: SparkSession, path: str) -> DataFrame:
    """(snapshot_id, record_count) of delimited files."""
    rows = spark.read.text(path).where(starts_record(F.col("value")))
    return rows.groupBy(F.input_file_name().alias("snapshot_id")).agg(F.count(F.lit(1)).alias("record_count"))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The delimited records; -0- and surrounding spaces are read as empty."""
    rows = spark.read.csv(path, schema=", ".join(f"{c} string" for c in CSV_COLUMNS), multiLine=True, escape='"')
    return rows.select(*[F.when(F.trim(c) != CSV_EMPTY, F.trim(c)).alias(c) for c in CSV_COLUMNS])


def new_files(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Rows of the manifest whose (source_list, publish_date, digest) has not been landed: nothing is written twice."""
    return manifest.join(landed, ["source_list", "publish_date", "digest"], "left_anti")


def land(files: DataFrame, landed: DataFrame, folder: str) -> DataFrame:
    """Write the content of new files to partitions of folder; returns what was new. Existing ones are never overwritten.

    Of files of the same version, the one with the smallest path is landed.
    """
    first = files.groupBy("source_list", "publish_date", "digest").agg(F.min("path").alias("path"))
    new = new_files(files.join(first, ["source_list", "publish_date", "digest", "path"], "left_semi"), landed).dropDuplicates(["source_list", "publish_date", "digest", "path"])
    new.write.partitionBy("source_list", "publish_date", "digest").mode("append").parquet(folder)
    return new.drop("content")


def read_landed(spark: SparkSession, folder: str, source_list: str, publish_date: str, digest: str) -> DataFrame:
    """The content of one landed version; other partitions are not read."""
    rows = spark.read.parquet(folder)
    return rows.where((F.col("source_list") == source_list) & (F.col("publish_date") == publish_date) & (F.col("digest") == digest))


def write_json_lines(records: DataFrame, path: str) -> None:
    """uid, type, name and alias names of each record, one JSON object a line."""
    records.select(F.col("fixed_ref").alias("uid"), F.col("entity_type").alias("type"), F.col("primary_name").alias("name"), F.transform("aliases", lambda a: a["name"]).alias("aliases")).write.json(path)


def read_json_arrays(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """JSON text columns as typed arrays; null and blank text is an empty array. columns: name to array type."""
    return rows.withColumns({c: F.coalesce(F.from_json(F.when(F.trim(c) != "", F.col(c)), kind), F.array().cast(kind)) for c, kind in columns.items()})
