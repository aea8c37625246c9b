"""A folder that holds every version of every list; facts about versions are commits in logs.

Raw bytes and records of a version are written to folders of their own and never changed. A version exists from the commit
that names its folder, and is active from the commit that activates it. Readers only look at versions that commits name,
so they see the old CURRENT or the new one, never a mix, and of writers that run at once each sees what the others did.
"""

from __future__ import annotations

import uuid
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeep import schemas
from rollkeep.operators import versions as v
from rollkeep.operators.counts import integrity, latest_checks
from rollkeep.operators.scope import check_source_list
from rollkeep.operators.search import with_search_columns
from rollkeep.sources import chunks
from rollkeep.sources.files import land
from rollkeep.sources.index import Index, changes, write
from rollkeep.sources.log import Log, exists, names_in

KEY = ["source_list", "publish_date", "digest"]
RECORDS = schemas.RECORD_FIELDS + ", primary_name_lower string, alias_search string"


class Store:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._versions = Log(spark, f"{self.folder}/versions", f"{schemas.VERSION}, attempt string")
        self._activations = Log(spark, f"{self.folder}/activations", schemas.ACTIVATION)
        self._checks = Log(spark, f"{self.folder}/integrity_checks", schemas.INTEGRITY)

    def _read(self, name: str, schema: str) -> DataFrame:
        """A table with its schema; empty before the first write."""
        if not exists(self.spark, f"{self.folder}/{name}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def versions(self) -> DataFrame:
        return self._versions.read().drop("number", "attempt")

    def activations(self) -> DataFrame:
        return self._activations.read().drop("number")

    def integrity_checks(self) -> DataFrame:
        return self._checks.read().drop("number")

    def records(self) -> DataFrame:
        """Records of all versions; reads prune to the versions asked for. What an attempt that was never committed has written is left out."""
        rows = self._read("records", f"{RECORDS}, source_list string, publish_date date, digest string, attempt string, table string, part int")
        return rows.where("table = 'rows'").join(self._versions.read().select("attempt"), "attempt", "left_semi").drop("attempt", "table", "part")

    def version_records(self, source_list: str, publish_date: date, digest: str) -> DataFrame:
        """The records of one version, from its folder alone; none if there is no such version."""
        held = self._index(source_list, publish_date, digest)
        rows = held.rows().drop("part") if held else self.spark.createDataFrame([], RECORDS)
        return v.stamp(rows, source_list, str(publish_date), digest)

    def _index(self, source_list: str, publish_date: date, digest: str) -> Index | None:
        row = self._one(self._versions.read(), source_list, publish_date, digest).select("attempt").first()
        return Index(self.spark, self._folder(source_list, publish_date, digest, row.attempt)) if row else None

    def changes(self, source_list: str, old: tuple[date, str] | None, new: tuple[date, str]) -> DataFrame:
        """(fixed_ref, change) between two versions (publish_date, digest) of a list, from the files that differ; without an old one all records are ADDED."""
        after = self._index(source_list, *new)
        before = self._index(source_list, *old) if old else None
        if before is None:
            return after.rows().select("fixed_ref", F.lit("ADDED").alias("change"))
        return changes(before, after)

    def index(self, source_list: str) -> Index | None:
        """The CURRENT version of a list at the time of the call, opened for pages and searches; None if there is none."""
        now = v.pointer(self.activations().where(F.col("source_list") == check_source_list(source_list)), "CURRENT").first()
        return self._index(source_list, now.publish_date, now.digest) if now else None

    def _folder(self, source_list: str, publish_date: date, digest: str, attempt: str) -> str:
        return f"{self.folder}/records/source_list={source_list}/publish_date={publish_date}/digest={digest}/attempt={attempt}"

    @staticmethod
    def _one(rows: DataFrame, source_list: str, publish_date: date, digest: str) -> DataFrame:
        return rows.where((F.col("source_list") == source_list) & (F.col("publish_date") == F.lit(publish_date)) & (F.col("digest") == digest))

    def has(self, source_list: str, publish_date: date, digest: str) -> bool:
        return not self._one(self.versions(), source_list, publish_date, digest).isEmpty()

    def raw(self) -> DataFrame:
        """The landed bytes of all versions, as they were written."""
        return self._read("raw", schemas.RAW)

    def land(self, files: DataFrame, source_list: str, publish_date: date) -> None:
        """Keep the bytes of files (path, length, digest, content); what is there already is never overwritten."""
        check_source_list(source_list)
        files = files.select(F.lit(source_list).alias("source_list"), F.lit(publish_date).alias("publish_date"), "digest", "path", "length", "content")
        land(files, self.raw().select(*KEY).distinct(), f"{self.folder}/raw")

    def take_in(self, path: str, sep: str) -> chunks.Held:
        """The bytes of landed files as chunks, aside, with the digests of what is stored."""
        return chunks.take_in(self.spark, path, f"{self.folder}/raw_chunks", sep)

    def keep_chunks(self, held: chunks.Held, source_list: str, publish_date: date, digest: str) -> bool:
        """Make what take_in wrote the bytes of a version; False, and what is there stays as it is, if there are some."""
        return chunks.keep(self.spark, held, f"{self.folder}/raw_chunks/source_list={check_source_list(source_list)}/publish_date={publish_date}/digest={digest}")

    def _chunk_table(self, name: str, schema: str) -> DataFrame:
        """A table of the chunks of all versions, by version."""
        root = f"{self.folder}/raw_chunks"
        kind = f"{schema}, source_list string, publish_date date, digest string"
        if not any("=" in n for n in names_in(self.spark, root)):
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(f"{kind}, table string").option("basePath", root).parquet(f"{root}/source_list=*/publish_date=*/digest=*/table={name}").drop("table")

    def changed_chunks(self, versions: DataFrame) -> DataFrame:
        """(source_list, publish_date, digest, path, number, why) of the chunks of some versions (by these columns) that are not as they were stored."""
        own = lambda rows: rows.join(versions.select(*KEY), KEY, "left_semi")
        return chunks.changed_chunks(own(self._chunk_table("chunks", chunks.CHUNK)), own(self._chunk_table("manifest", chunks.MANIFEST)), tuple(KEY))

    def _bytes_ok(self, versions: DataFrame) -> DataFrame:
        """versions with ok: all bytes that are stored for each, in one piece or in chunks, have its digest, and there are some.

        A version in chunks has the digest of its manifest, and each chunk the digest that this names.
        """
        whole = integrity(versions.join(self.raw().select(*KEY).distinct(), KEY, "left_semi"), self.raw().join(versions, KEY, "left_semi"))
        manifest = self._chunk_table("manifest", chunks.MANIFEST).where(F.col("number") == chunks.WHOLE).join(versions.select(*KEY), KEY, "left_semi")
        bad = self.changed_chunks(versions).select(*KEY).distinct().withColumn("bad", F.lit(True))
        cut = manifest.join(bad, KEY, "left").select(*KEY, ((F.col("sum") == F.col("digest")) & F.col("bad").isNull()).alias("ok"))
        found = whole.select(*KEY, "ok").unionByName(cut).groupBy(*KEY).agg(F.bool_and("ok").alias("ok"))
        return versions.join(found, KEY, "left").withColumn("ok", F.coalesce("ok", F.lit(False)))

    def stored_bytes_ok(self, source_list: str, publish_date: date, digest: str) -> bool:
        """Whether the stored bytes of a version, read again, have its digest; False if there are none."""
        one = self.spark.createDataFrame([(source_list, publish_date, digest)], "source_list string, publish_date date, digest string")
        return self._bytes_ok(one).first().ok

    def check_cold(self, source_list: str, now: datetime | None = None) -> DataFrame:
        """Hash the stored bytes of the list's COLD versions again and add the results to the integrity checks; returns them."""
        own = lambda rows: rows.where(F.col("source_list") == check_source_list(source_list))
        found = self._bytes_ok(v.cold_versions(own(self.versions()).select(*KEY), own(self.activations())).drop("state"))
        at = now or datetime.now(UTC)
        rows = [{**r.asDict(), "checked_at": at} for r in found.select(*KEY, "ok").collect()]  # one row for each cold version
        if rows:
            self._checks.append(lambda _: rows)
        return self.spark.createDataFrame([(r["source_list"], r["publish_date"], r["digest"], r["ok"], at) for r in rows], schemas.INTEGRITY)

    def unusable(self) -> DataFrame:
        """Versions whose latest integrity check failed; their recorded digests stay as they are."""
        return latest_checks(self.integrity_checks()).where("not ok").select(*KEY)

    def put_isolated(self, records: DataFrame, source_list: str, publish_date: date, digest: str, counts: dict[str, int], raw_path: str, now: datetime | None = None) -> bool:
        """Write a version that no reader sees yet; False, and no version is added, if it exists already.

        Records go to a folder of this attempt; the commit that names it makes the version. Of writers that put the same
        version at once, one commits; what the others wrote is never read, and `leftovers` lists it.
        """
        check_source_list(source_list)
        if self.has(source_list, publish_date, digest):
            return False
        fields = [f.split(" ")[0] for f in schemas.top_level(schemas.RECORD_FIELDS)]
        attempt = uuid.uuid4().hex
        folder = self._folder(source_list, publish_date, digest, attempt)
        write(with_search_columns(records.select(*fields)), folder)
        n = self.spark.read.schema(RECORDS).parquet(f"{folder}/table=rows").count()
        row = {"source_list": source_list, "publish_date": publish_date, "digest": digest, "record_count": counts.get("record_count"), "out_of_scope_count": counts.get("out_of_scope_count"), "overlap_count": counts.get("overlap_count", 0), "expected_count": counts.get("expected_count"), "persisted_count": n, "ingested_at": now or datetime.now(UTC), "raw_path": raw_path, "attempt": attempt}
        return self._versions.append(lambda done: [row] if self._one(done, source_list, publish_date, digest).isEmpty() else None) is not None

    def leftovers(self) -> list[str]:
        """Folders of records that no commit names, of attempts that failed, lost or still run."""
        named = {r.attempt for r in self._versions.read().select("attempt").collect()}  # one row for each version
        root, out = f"{self.folder}/records", []
        for a in names_in(self.spark, root):
            for b in names_in(self.spark, f"{root}/{a}"):
                for c in names_in(self.spark, f"{root}/{a}/{b}"):
                    out += [f"{root}/{a}/{b}/{c}/{d}" for d in names_in(self.spark, f"{root}/{a}/{b}/{c}") if d.removeprefix("attempt=") not in named]
        return out

    def count(self, source_list: str, publish_date: date, digest: str) -> int:
        return self.version_records(source_list, publish_date, digest).count()

    def _activation(self, done: DataFrame, source_list: str, publish_date: date, digest: str, now: datetime | None) -> list[dict] | None:
        """The row that follows the activations so far; none unless the version exists and its last integrity check did not fail."""
        if not self.has(source_list, publish_date, digest) or not self._one(self.unusable(), source_list, publish_date, digest).isEmpty():
            return None
        last = done.where(F.col("source_list") == source_list).agg(F.max("seq")).first()[0]
        return [{"source_list": source_list, "seq": (last or 0) + 1, "publish_date": publish_date, "digest": digest, "activated_at": now or datetime.now(UTC)}]

    def activate(self, source_list: str, publish_date: date, digest: str, now: datetime | None = None) -> bool:
        """Commit an activation; False, and nothing changed, unless the version exists in that list and its last integrity check did not fail."""
        return self._activations.append(lambda done: self._activation(done, source_list, publish_date, digest, now)) is not None

    def publish(self, source_list: str, publish_date: date, digest: str) -> str:
        """ACTIVATED if the persisted count is the expected one, else COUNT_MISMATCH or NO_VERSION with pointers untouched."""
        row = self.versions().where((F.col("source_list") == source_list) & (F.col("publish_date") == F.lit(publish_date)) & (F.col("digest") == digest)).first()
        if row is None:
            return "NO_VERSION"
        if row.expected_count is None or row.expected_count != row.persisted_count:
            return "COUNT_MISMATCH"
        return "ACTIVATED" if self.activate(source_list, publish_date, digest) else "REPOINT_FAILED"

    def rollback(self, source_list: str) -> str:
        """Activate PREVIOUS again, as it is when the commit happens; NO_PREVIOUS if there is none."""
        why = "REPOINT_FAILED"

        def decide(done: DataFrame) -> list[dict] | None:
            nonlocal why
            row = v.pointer(done.where(F.col("source_list") == source_list), "PREVIOUS").first()
            why = "REPOINT_FAILED" if row else "NO_PREVIOUS"
            return self._activation(done, source_list, row.publish_date, row.digest, None) if row else None

        return "ACTIVATED" if self._activations.append(decide) is not None else why

    def trio(self) -> DataFrame:
        return v.trio(self.activations())

    def current(self, source_list: str) -> DataFrame:
        """The records of the list's CURRENT version at the time of the call; none if there is no such version."""
        now = v.pointer(self.activations().where(F.col("source_list") == check_source_list(source_list)), "CURRENT").first()
        if now is None:
            return v.stamp(self.spark.createDataFrame([], RECORDS), source_list, "1970-01-01", "")
        return self.version_records(source_list, now.publish_date, now.digest)

    def record_check(self, source_list: str, publish_date: date, digest: str, ok: bool, now: datetime | None = None) -> None:
        self._checks.append(lambda _: [{"source_list": source_list, "publish_date": publish_date, "digest": digest, "ok": ok, "checked_at": now or datetime.now(UTC)}])
