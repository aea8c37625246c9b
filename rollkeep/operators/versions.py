"""Versions as rows: activations are appended, and pointers, HOT or COLD and retention follow from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VERSION = ["publish_date", "digest"]
#: The pointers of a list, newest first.
POINTERS = ("CURRENT", "PREVIOUS", "N_MINUS_2")


def trio(activations: DataFrame, version: list[str] = VERSION) -> DataFrame:
    """(source_list, pointer, version): the last three activations of each list; repeated ones count again, as after a rollback.

    Only three rows of a list are ever gathered: the window limit is pushed below its shuffle. Rows of two writers that
    chose the same seq are ordered by version, so every reader sees the same pointers; seq_conflicts tells them.
    """
    w = Window.partitionBy("source_list").orderBy(F.col("seq").desc(), *[F.col(c).desc() for c in version])
    rows = activations.withColumn("rn_", F.row_number().over(w)).where("rn_ <= 3")
    return rows.select("source_list", F.element_at(F.array(*[F.lit(p) for p in POINTERS]), F.col("rn_")).alias("pointer"), *version)


def seq_conflicts(activations: DataFrame) -> DataFrame:
    """(source_list, seq, n) of sequence numbers that more than one activation of a list has: writers that ran at once."""
    return activations.groupBy("source_list", "seq").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def pointer(activations: DataFrame, name: str, version: list[str] = VERSION) -> DataFrame:
    """The version each list's pointer names; lists without it have no row."""
    return trio(activations, version).where(F.col("pointer") == name).drop("pointer")


def hot_cold(versions: DataFrame, activations: DataFrame, version: list[str] = VERSION) -> DataFrame:
    """versions with state: HOT if a pointer of its list names it, else COLD; never activated ones are COLD."""
    hot = trio(activations, version).select("source_list", *version).distinct().withColumn("hot_", F.lit(True))
    return versions.join(hot, ["source_list", *version], "left").withColumn("state", F.when(F.col("hot_"), "HOT").otherwise("COLD")).drop("hot_")


def cold_versions(versions: DataFrame, activations: DataFrame, version: list[str] = VERSION) -> DataFrame:
    return hot_cold(versions, activations, version).where("state = 'COLD'")


def rollback_rows(activations: DataFrame, version: list[str] = VERSION) -> DataFrame:
    """The activation rows that a rollback of every list appends: its PREVIOUS again. Lists without one have none."""
    last = activations.groupBy("source_list").agg(F.max("seq").alias("seq"))
    return pointer(activations, "PREVIOUS", version).join(last, "source_list").select("source_list", (F.col("seq") + 1).alias("seq"), *version)


def rolled_back(activations: DataFrame, version: list[str] = VERSION) -> DataFrame:
    return activations.select("source_list", "seq", *version).unionByName(rollback_rows(activations, version))


def last_ingested(versions: DataFrame) -> DataFrame:
    """The version of each list that was ingested last, activated or not; later date and digest decide ties."""
    return versions.groupBy("source_list").agg(F.max_by(F.struct(*[c for c in versions.columns if c != "source_list"]), F.struct("ingested_at", "publish_date", "digest")).alias("v")).select("source_list", "v.*")


def purge_plan(versions: DataFrame, activations: DataFrame, keep_all: bool, version: list[str] = VERSION, older_than=None) -> DataFrame:
    """Versions whose raw file may go: none with keep_all, else the COLD ones; older_than (a column) also asks for age.

    Only the plan is made; nothing is deleted.
    """
    cold = cold_versions(versions, activations, version)
    if keep_all:
        return cold.limit(0)
    return cold if older_than is None else cold.where(F.col("ingested_at") < older_than)


def stamp(records: DataFrame, source_list: str, publish_date: str, digest: str) -> DataFrame:
    """Records with the identity of their version."""
    return records.withColumns({"source_list": F.lit(source_list), "publish_date": F.lit(publish_date).cast("date"), "digest": F.lit(digest)})
