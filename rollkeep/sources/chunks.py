"""Raw files in chunks of one size, with a digest for each and one for the whole; no file stands in one row.

A file is read in ranges, whose places are known from the bytes before them, and cut at multiples of the chunk size. Its
manifest is taken from the chunks as they are stored: they pass one task of the file in order, some megabytes at a time, as
SHA-256 asks. Later checks hash the chunks apart and name those that changed.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeep.sources.log import exists, moved
from rollkeep.sources.pieces import pieces, ranges

SIZE = 1 << 22
#: Bytes that pass to a Python worker at once.
AT_ONCE = 1 << 25
MARK = b"\xef\xbb\xbf"
#: The number of the manifest's row for a whole file.
WHOLE = -1
CHUNK = "path string, number long, content binary"
MANIFEST = "path string, number long, length long, sum string"


class Held(NamedTuple):
    """Chunks and manifest of files, written aside; path: their common folder."""

    folder: str
    chunks: DataFrame
    manifest: DataFrame


def chunks_of(spark: SparkSession, path: str, sep: str = ">", size: int = SIZE) -> DataFrame:
    """(path, number, content): the bytes of each file, `size` in each chunk but the last. sep: a byte that files hold often."""
    rows = pieces(spark, path, sep)
    counted = rows.groupBy("file", "place", "length").agg(F.sum(F.octet_length("piece") + 1).alias("n"))
    counted = counted.groupBy("file", "length").agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("place", "n"))).alias("own"))
    marked = (F.col("total") + len(MARK)).isin(F.col("length"), F.col("length") + 1)  # the reader drops a byte order mark
    told = counted.where(marked | (F.size("own") > 1)).select("file", marked.alias("mark"), "own").collect()  # files of one range without a mark begin at 0
    starts: dict[tuple[str, int], tuple[int, bool]] = {}
    for r in told:
        at = len(MARK) if r.mark else 0
        for k, x in enumerate(r.own):
            starts[r.file, x.place] = (at, r.mark and k == 0)
            at += x.n
    end = sep.encode()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, place, length), lists in ranges(batches):
            at, mark = starts.get((file, place), (0, False))
            held = MARK if mark else b""
            at -= len(held)

            def part(content: bytes, at: int, file: str = file) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array([file]), pa.array([at // size], pa.int64()), pa.array([at % size], pa.int64()), pa.array([content], pa.binary())], ["path", "number", "at", "content"])

            for x in lists:
                held += end.join(x) + end
                while len(held) > size - at % size:  # a byte at least stays, as the last may be too much
                    room = size - at % size
                    yield part(held[:room], at)
                    at, held = at + room, held[room:]
            held = held[:-1] if at + len(held) > length else held  # the last piece of a file may lack its sep
            if held:
                yield part(held, at)

    parts = rows.mapInArrow(cut, "path string, number long, at long, content binary").groupBy("path", "number").agg(F.array_sort(F.collect_list(F.struct("at", "content"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda now, x: F.concat(now, x.content))
    return parts.select("path", "number", F.when(F.size("parts") == 1, F.col("parts")[0].content).otherwise(joined).alias("content"))


def manifest_of(chunks: DataFrame) -> DataFrame:
    """(path, number, length, sum: SHA-256) of all chunks, and of each whole file under the number WHOLE."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(path: str, number: int, length: int, digest: str) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([number], pa.int64()), pa.array([length], pa.int64()), pa.array([digest])], ["path", "number", "length", "sum"])

        now, whole, length = None, hashlib.sha256(), 0
        for batch in batches:
            for k in range(batch.num_rows):
                path, number, content = (batch.column(c)[k].as_py() for c in range(3))
                if path != now:
                    if now is not None:
                        yield row(now, WHOLE, length, whole.hexdigest())
                    now, whole, length = path, hashlib.sha256(), 0
                whole.update(content)
                length += len(content)
                yield row(path, number, len(content), hashlib.sha256(content).hexdigest())
        if now is not None:
            yield row(now, WHOLE, length, whole.hexdigest())

    return chunks.repartition("path").sortWithinPartitions("path", "number").select("path", "number", "content").mapInArrow(hashed, MANIFEST)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs started within pass AT_ONCE bytes at a time to Python workers."""
    kept = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(AT_ONCE))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", kept)


def digest_of(spark: SparkSession, path: str, sep: str = ">") -> str | None:
    """The SHA-256 of the one file at path, which passes its task in chunks; null if it holds no byte."""
    with small_batches(spark):
        whole = manifest_of(chunks_of(spark, path, sep)).where(F.col("number") == WHOLE).select("sum").first()
    return whole and whole["sum"]


def take_in(spark: SparkSession, path: str, folder: str, sep: str = ">", size: int = SIZE) -> Held:
    """Write the chunks of files aside within folder, and the manifest of what is stored there."""
    aside = f"{folder}/_aside-{uuid.uuid4().hex}"
    with small_batches(spark):
        chunks_of(spark, path, sep, size).write.parquet(f"{aside}/table=chunks")
        stored = spark.read.schema(CHUNK).parquet(f"{aside}/table=chunks")
        manifest_of(stored).write.parquet(f"{aside}/table=manifest")
    return Held(aside, stored, spark.read.schema(MANIFEST).parquet(f"{aside}/table=manifest"))


def keep(spark: SparkSession, held: Held, folder: str) -> bool:
    """Give what was written aside its place; False, with nothing changed, if that place is taken."""
    if exists(spark, folder):
        return False
    return moved(spark, held.folder, folder)


def opened(spark: SparkSession, folder: str) -> Held:
    return Held(folder, spark.read.schema(CHUNK).parquet(f"{folder}/table=chunks"), spark.read.schema(MANIFEST).parquet(f"{folder}/table=manifest"))


def changed_chunks(chunks: DataFrame, manifest: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, path, number, why) of chunks that are MISSING, CHANGED, EXTRA or there TWICE, against the manifest; every chunk is hashed where it is read."""
    key = [*by, "path", "number"]
    now = chunks.select(*key, F.sha2("content", 256).alias("now")).groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("now").alias("now"))
    rows = manifest.where(F.col("number") != WHOLE).join(now, key, "full")
    why = F.when(F.col("now").isNull(), "MISSING").when(F.col("length").isNull(), "EXTRA").when(F.col("n") > 1, "TWICE").when(F.col("now") != F.col("sum"), "CHANGED")
    return rows.withColumn("why", why).where("why is not null").select(*key, "why")


def restored(held: Held, path: str) -> DataFrame:
    """The chunks of one file in order (number, content); joined, they are the file."""
    return held.chunks.where(F.col("path") == path).select("number", "content").orderBy("number")
