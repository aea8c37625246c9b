"""Screening that remembers: texts of a stream against the CURRENT names of a list, and past texts again when CURRENT moves.

Texts are kept with an index of their words. Each batch of texts has been screened up to some activation; to catch up is to
screen batches that are behind against the names that they have not been screened against. Every step is a batch that
appears once, and says which texts it covers up to which activation, so a step that is repeated, or was lost on the way,
adds no hit twice and misses none.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rollkeep.operators.versions import pointer
from rollkeep.sources.index import TextIndex
from rollkeep.sources.log import names_in, put_batch
from rollkeep.sources.store import Store

HIT = "id string, needle string, seq long"
COVER = "texts string, seq long"


class Watch:
    """Hits of one list's names in the texts of streams, in a folder of its own."""

    def __init__(self, store: Store, source_list: str, folder: str) -> None:
        self.store, self.spark, self.source_list, self.folder = store, store.spark, source_list, folder
        self.index = TextIndex(store.spark, f"{folder}/index")

    def _batches(self, name: str) -> list[str]:
        return [n for n in names_in(self.spark, f"{self.folder}/{name}") if n.startswith("batch=")]

    def _table(self, name: str, schema: str) -> DataFrame:
        """A table of all steps so far."""
        paths = [f"{self.folder}/steps/{b}/table={name}" for b in self._batches("steps")]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def hits(self) -> DataFrame:
        """(id, needle, seq): each text and name once, with the number of the activation that was CURRENT when it was found."""
        return self._table("hits", HIT)

    def texts(self) -> DataFrame:
        """(id, text, batch): all texts so far."""
        kind = "id string, text string"
        return self.spark.read.schema(f"{kind}, batch string").parquet(f"{self.folder}/texts") if self._batches("texts") else self.spark.createDataFrame([], f"{kind}, batch string")

    def _names(self, seq: int) -> DataFrame:
        """The names of the version that an activation names."""
        row = self.store.activations().where((F.col("source_list") == self.source_list) & (F.col("seq") == seq)).first()
        return self.store.version_records(self.source_list, row.publish_date, row.digest).select(F.lower("primary_name").alias("name")).distinct()

    def take(self, rows: DataFrame, text_id: str, text: str, batch: str) -> int:
        """Keep texts as a batch of this name, if it is not there, and catch up; returns the number of steps that were made. Ids are told apart as text."""
        rows = rows.select(F.col(text_id).cast("string").alias("id"), F.col(text).alias("text"))
        put_batch(rows, f"{self.folder}/texts", batch)
        return self.catch_up()

    def catch_up(self) -> int:
        """Screen what is behind the list's last activation: new texts against all its names, and others against the names that are new to them."""
        now = self.store.activations().where(F.col("source_list") == self.source_list)
        if pointer(now, "CURRENT").first() is None:
            return 0
        seq = now.agg(F.max("seq")).first()[0]
        covered = {r.texts: r.seq for r in self._table("covers", COVER).groupBy("texts").agg(F.max("seq").alias("seq")).collect()}  # one row for each batch of texts
        behind: dict[int, list[str]] = {}
        for b in (n.removeprefix("batch=") for n in self._batches("texts")):
            if covered.get(b, 0) < seq:
                behind.setdefault(covered.get(b, 0), []).append(b)
        made = 0
        for last, batches in sorted(behind.items()):
            texts = self.texts().where(F.col("batch").isin(batches))
            names = self._names(seq)
            if last:
                fresh = names.join(self._names(last), "name", "left_anti")
                found = self.index.screen(texts, "id", "text", fresh, "name", batches)
            else:
                for b in batches:
                    self.index.add(texts.where(F.col("batch") == b), "id", "text", b)
                found = self.index.screen(texts, "id", "text", names, "name", batches)
            new = found.join(self.hits().select("id", "needle"), ["id", "needle"], "left_anti").withColumn("seq", F.lit(seq).cast("long"))
            cover = self.spark.createDataFrame([(b, seq) for b in batches], COVER)
            step = f"{seq}-{hashlib.sha256('/'.join(batches).encode()).hexdigest()[:16]}"
            made += put_batch({"hits": new.select("id", "needle", "seq"), "covers": cover}, f"{self.folder}/steps", step)
        return made

    def follow(self, events: DataFrame, text_id: str, text: str, checkpoint: str, **trigger) -> StreamingQuery:
        """Take each micro-batch of a stream; a batch that is replayed is there already."""

        def batch(rows: DataFrame, number: int) -> None:
            query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            self.take(rows, text_id, text, f"{query}-{number}")

        return events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
