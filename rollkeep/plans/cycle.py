"""The ingestion cycle: obtain, validate, transform, version, persist, publish; and its outcomes as a table."""

from __future__ import annotations

from datetime import UTC, date, datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeep.functions.scalar import complete_download, publish_date
from rollkeep.operators.counts import changed, validated
from rollkeep.operators.dedup import dedup_within
from rollkeep.operators.resolve import first_failure, resolve
from rollkeep.operators.scope import scope_counts
from rollkeep.operators.versions import pointer
from rollkeep.schemas import OUTCOME
from rollkeep.sources.chunks import WHOLE, Held
from rollkeep.sources.log import removed
from rollkeep.sources.mapping import XML_MAPPING, Mapping, check_sections
from rollkeep.sources.scratch import stored
from rollkeep.sources.store import Store


class Outcome(NamedTuple):
    """SKIPPED, ACTIVATED or FAILED; for the last, the stage and the cause."""

    source_list: str
    status: str
    failed_stage: str | None = None
    cause: str | None = None
    publish_date: date | None = None
    digest: str | None = None


def run_cycle(
    spark: SparkSession, store: Store, source_list: str, path: str, digest_header: str | None, last_modified: str | None = None,
    status: int = 200, redirects: int | None = None, content_length: int | None = None, mapping: Mapping = XML_MAPPING,
) -> Outcome:
    """Take one downloaded snapshot through all stages. Only counts and one-row results reach the driver.

    digest_header, last_modified, status, redirects and content_length are what the publisher said of the download. The
    snapshot is parsed once; records are resolved once. Its bytes are stored in chunks first, and the digest is that of what
    is stored; they are read again and hashed, and only if they still have the digest are records written, the check recorded and the version activated. Every failure is an outcome and
    leaves the pointers as they are; nothing is raised for what data holds.
    """
    held = store.take_in(path, mapping.sep)
    try:
        return _cycle(spark, store, source_list, path, held, digest_header, last_modified, status, redirects, content_length, mapping)
    finally:
        removed(spark, held.folder)  # unless it has become the version's


def _cycle(
    spark: SparkSession, store: Store, source_list: str, path: str, held: Held, digest_header: str | None, last_modified: str | None,
    status: int, redirects: int | None, content_length: int | None, mapping: Mapping,
) -> Outcome:
    """run_cycle, of bytes that are stored aside."""
    raw = held.manifest.where(F.col("number") == WHOLE).select("path", "length", F.col("sum").alias("actual_digest"), F.lit(True).alias("well_formed"))
    said = {"digest_header": F.lit(digest_header).cast("string"), "complete": complete_download(F.lit(status), F.lit(redirects).cast("int"), F.lit(content_length).cast("long"), F.col("length"))}
    checked = validated(raw.withColumns(said)).select("path", "actual_digest", "claimed_digest", "verdict", "complete").first()
    if checked is None:
        return Outcome(source_list, "FAILED", "OBTAIN", "NOTHING_LANDED")
    digest = checked.actual_digest
    now = pointer(store.activations().where(F.col("source_list") == source_list), "CURRENT").first()
    if now is not None and checked.claimed_digest == now.digest:
        return Outcome(source_list, "SKIPPED", None, None, now.publish_date, now.digest)
    if not checked.complete:
        return Outcome(source_list, "FAILED", "OBTAIN", "INCOMPLETE_DOWNLOAD")
    if checked.verdict != "OK":
        return Outcome(source_list, "FAILED", "VALIDATE", checked.verdict)
    sections, wrong = mapping.read(spark, path)
    if wrong:
        return Outcome(source_list, "FAILED", "VALIDATE", wrong)
    check_sections(sections)
    issued = spark.range(1).join(sections["issued"].drop("snapshot_id"), F.lit(True), "left")  # one row
    day = issued.select(publish_date(F.col("year"), F.col("month"), F.col("day"), F.lit(last_modified).cast("string"), F.lit(datetime.now(UTC).date())).alias("d")).first().d
    records = stored(resolve(sections)[0])
    bad = first_failure(records).where("status = 'FAILED'").first()
    if bad is not None:
        return Outcome(source_list, "FAILED", "TRANSFORM", f"{bad.reject_reason} {bad.fixed_ref}", day, digest)
    counts = scope_counts(sections["profiles"]).first()
    total, out = (counts.record_count, counts.out_of_scope_count) if counts else (0, 0)
    plan = {"record_count": total, "out_of_scope_count": out, "overlap_count": 0, "expected_count": total - out}
    store.keep_chunks(held, source_list, day, digest)
    if not store.stored_bytes_ok(source_list, day, digest):
        store.record_check(source_list, day, digest, False)
        return Outcome(source_list, "FAILED", "PERSIST", "RAW_INTEGRITY", day, digest)
    if not store.put_isolated(dedup_within(records), source_list, day, digest, plan, checked.path) and now is not None and now.digest == digest:
        return Outcome(source_list, "SKIPPED", None, None, day, digest)
    store.record_check(source_list, day, digest, True)
    published = store.publish(source_list, day, digest)
    return Outcome(source_list, "ACTIVATED", None, None, day, digest) if published == "ACTIVATED" else Outcome(source_list, "FAILED", "PUBLISH", published, day, digest)


def tick(spark: SparkSession, store: Store, manifest: list[dict]) -> DataFrame:
    """Run the cycle for each row of a manifest (arguments of run_cycle); one that fails does not stop the others."""
    out = []
    for row in manifest:
        try:
            out.append(run_cycle(spark, store, **row))
        except Exception as error:  # a broken file or store is that list's failure
            out.append(Outcome(row["source_list"], "FAILED", "CYCLE", str(error).split("\n")[0][:300]))
    return spark.createDataFrame([tuple(o) for o in out], OUTCOME)


def outcomes(snapshots: DataFrame, last: DataFrame) -> DataFrame:
    """The outcome of many snapshots at once, as columns status, failed_stage and cause.

    snapshots: source_list, complete, digest_header, digest (advertised), actual_digest, well_formed, reject_reason,
    expected_count, persisted_count, advertised_date, advertised_count. The first stage that fails decides.
    """
    rows = validated(changed(snapshots, last))
    stage = (
        F.when(F.col("decision") == "UNCHANGED", None)
        .when(~F.coalesce(F.col("complete"), F.lit(False)), "OBTAIN|INCOMPLETE_DOWNLOAD")
        .when(F.col("verdict") != "OK", F.concat(F.lit("VALIDATE|"), "verdict"))
        .when(F.col("reject_reason").isNotNull(), F.concat(F.lit("TRANSFORM|"), "reject_reason"))
        .when(~F.col("expected_count").eqNullSafe(F.col("persisted_count")), "PUBLISH|COUNT_MISMATCH")
    )
    rows = rows.withColumn("stage_", stage)
    status = F.when(F.col("decision") == "UNCHANGED", "SKIPPED").when(F.col("stage_").isNull(), "ACTIVATED").otherwise("FAILED")
    return rows.withColumns({"status": status, "failed_stage": F.split_part("stage_", F.lit("|"), F.lit(1)), "cause": F.split_part("stage_", F.lit("|"), F.lit(2))}).drop("stage_")
