"""Counts that must agree before a version may be activated, and the state of stored bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeep.functions.scalar import complete_download, normalise_digest
from rollkeep.operators.versions import VERSION, cold_versions


def expected_count(counts: DataFrame) -> DataFrame:
    """counts (record_count, out_of_scope_count, overlap_count) with expected_count."""
    return counts.withColumn("expected_count", F.col("record_count") - F.col("out_of_scope_count") - F.coalesce("overlap_count", F.lit(0)))


def count_gate(counts: DataFrame) -> DataFrame:
    """counts (expected_count, persisted_count) with gate: OK or COUNT_MISMATCH; a null on either side does not pass."""
    return counts.withColumn("gate", F.when(F.col("expected_count") == F.col("persisted_count"), "OK").otherwise("COUNT_MISMATCH"))


def overlap(per_list_in_scope: DataFrame, union_size: DataFrame) -> DataFrame:
    """overlap_count: the sum of the lists' distinct records in scope, less the size of their distinct union."""
    total = per_list_in_scope.agg(F.sum("in_scope_count").alias("t"))
    return total.join(union_size.select(F.col("n").alias("u"))).select((F.col("t") - F.col("u")).alias("overlap_count"))


def changed(manifest: DataFrame, last: DataFrame) -> DataFrame:
    """manifest (source_list, digest, advertised_date, advertised_count) with decision CHANGED or UNCHANGED against the last version.

    Without an earlier version it is changed. With an advertised digest only the digest counts; without one it is
    unchanged only if date and count are both advertised and both equal.
    """
    old = last.select("source_list", F.col("digest").alias("old_digest"), F.col("publish_date").alias("old_date"), F.col("record_count").alias("old_count"), F.lit(True).alias("had"))
    rows = manifest.join(old, "source_list", "left")
    same = F.when(F.col("digest").isNotNull(), F.col("digest") == F.col("old_digest")).otherwise((F.col("advertised_date") == F.col("old_date")) & (F.col("advertised_count") == F.col("old_count")))
    unchanged = F.coalesce(F.col("had"), F.lit(False)) & F.coalesce(same, F.lit(False))
    return rows.withColumn("decision", F.when(unchanged, "UNCHANGED").otherwise("CHANGED")).drop("old_digest", "old_date", "old_count", "had")


def validated(files: DataFrame) -> DataFrame:
    """files (digest_header, actual_digest, well_formed) with verdict: the first check that fails, else OK."""
    claimed = normalise_digest(F.col("digest_header"))
    out = F.when(claimed.isNull(), "ABSENT_DIGEST").when(claimed != F.col("actual_digest"), "DIGEST_MISMATCH").when(~F.coalesce(F.col("well_formed"), F.lit(False)), "MALFORMED_XML").otherwise("OK")
    return files.withColumns({"claimed_digest": claimed, "verdict": out})


def downloads(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """manifest joined to what has landed (path, length), with complete."""
    rows = manifest.join(files.select("path", "length"), "path", "left")
    return rows.withColumn("complete", complete_download(F.col("status"), F.col("redirects"), F.col("content_length"), F.col("length")))


def integrity(versions: DataFrame, stored: DataFrame) -> DataFrame:
    """versions (source_list, publish_date, digest) with ok: whether the stored bytes still have that digest; missing ones are not ok."""
    key = ["source_list", "publish_date", "digest"]
    now = stored.select(*key, F.sha2("content", 256).alias("now"))
    return versions.join(now, key, "left").withColumn("ok", F.coalesce(F.col("now") == F.col("digest"), F.lit(False))).drop("now")


def cold_checks(versions: DataFrame, activations: DataFrame, stored: DataFrame, version: list[str] | None = None) -> DataFrame:
    """COLD versions with ok: whether their stored bytes still have the recorded digest. To be appended to the integrity checks; the record itself stays."""
    return integrity(cold_versions(versions, activations, version or VERSION).drop("state"), stored)


def latest_checks(checks: DataFrame) -> DataFrame:
    """The latest integrity result of each version."""
    key = ["source_list", "publish_date", "digest"]
    return checks.groupBy(*key).agg(F.max_by("ok", "checked_at").alias("ok"))
