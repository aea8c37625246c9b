"""Continuous work with Structured Streaming: ingest landed files, screen events, follow changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rollkeep.operators.search import screen
from rollkeep.plans.cycle import tick
from rollkeep.schemas import MANIFEST
from rollkeep.sources.log import exists, names_in, put_batch
from rollkeep.sources.store import Store

BINARY = "path string, modificationTime timestamp, length long, content binary"


def _batch_of(rows: DataFrame, number: int) -> str:
    """The name of a micro-batch: the same when a stream is started again from its checkpoint, another for any other stream."""
    return f"{rows.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number}"


def advertised(files: DataFrame, said: DataFrame) -> DataFrame:
    """files (path) with what a manifest says of each (said: path, when, and what is advertised); null where no row names it.

    A row names a file by its path or by the end of it, in whole folders and names: a.xml, or 2026/a.xml where folders
    differ. The longest such end counts, then the latest `when`; of rows that tie, the one with the larger values.
    """
    parts = F.split("path", "/+")
    ends = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, -n, n), "/"))
    clean = F.regexp_replace("path", r"/+", "/")
    what = [c for c in said.columns if c not in ("path", "when")]
    rows = said.select(clean.alias("end"), F.struct("when", *what).alias("said"))
    asked = files.select("path", F.posexplode(ends).alias("n", "end"))
    best = asked.join(rows, "end").groupBy("path").agg(F.max(F.struct("n", "said")).alias("best"))
    return files.join(best, "path", "left").select(*files.columns, *[F.col(f"best.said.{c}").alias(c) for c in what])


def ingest(spark: SparkSession, store: Store, landing: str, checkpoint: str, manifest: str, source_list: str = "SDN", **trigger) -> StreamingQuery:
    """Take each file that lands through the cycle once; a replayed batch finds its version there and changes nothing.

    manifest: a folder of JSON lines that say what the publisher advertised of each file (path or the end of it,
    digest_header, last_modified, status, redirects, content_length), written before the file itself lands. A file that no
    manifest row names has no digest and fails. Of several rows for a file, those in the file that was written last count. A
    file that fails in any way does not stop the others. The outcomes of a batch are added to the store once. The driver
    sees the paths and manifest rows of new files only. trigger: availableNow=True as set, or processingTime="6 hours".
    """

    def batch(files: DataFrame, number: int) -> None:
        said = spark.read.schema(MANIFEST).json(manifest) if exists(spark, manifest) else spark.createDataFrame([], MANIFEST)
        when = F.col("_metadata.file_modification_time") if exists(spark, manifest) else F.lit(None).cast("timestamp")
        rows = advertised(files.select("path", "modificationTime"), said.select("*", when.alias("when"))).orderBy("modificationTime", "path").drop("modificationTime")
        # a batch holds the few snapshots that are new
        asked = [{"source_list": source_list} | r.asDict() | ({"status": 200} if r.status is None else {}) for r in rows.toLocalIterator()]
        if asked:
            put_batch(tick(spark, store, asked), f"{store.folder}/outcomes", _batch_of(files, number))

    stream = spark.readStream.format("binaryFile").schema(BINARY).load(landing)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def screen_stream(events: DataFrame, event_id: str, text: str, store: Store, source_list: str, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Screen a stream of texts against the CURRENT names; each micro-batch looks CURRENT up anew and adds its hits to out, once."""

    def batch(rows: DataFrame, number: int) -> None:
        names = store.current(source_list).select(F.col("primary_name").alias("name")).distinct()
        put_batch(screen(rows, event_id, text, names, "name"), out, _batch_of(rows, number))

    return events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def append_changes(store: Store, source_list: str, out: str, seq: int | None = None) -> bool:
    """Add what an activation of a list (the last one, or that of a number) changed to a table that streams may follow: fixed_ref, change, version.

    Each activation is there once, however often this is called; False if it is there already, or there is none.
    """
    rows = store.activations().where(F.col("source_list") == source_list)
    rows = rows if seq is None else rows.where(F.col("seq") <= seq)
    two = rows.orderBy(F.col("seq").desc()).limit(2).collect()
    if not two or (seq is not None and two[0].seq != seq):
        return False
    found = store.changes(source_list, (two[1].publish_date, two[1].digest) if len(two) > 1 else None, (two[0].publish_date, two[0].digest))
    found = found.withColumns({"source_list": F.lit(source_list), "publish_date": F.lit(two[0].publish_date), "digest": F.lit(two[0].digest)})
    return put_batch(found, out, f"{source_list}-{two[0].seq}")


def changes(spark: SparkSession, path: str) -> DataFrame:
    """The change feed as a stream."""
    return spark.readStream.schema("fixed_ref string, change string, source_list string, publish_date date, digest string").parquet(path)
