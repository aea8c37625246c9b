"""The bytes of files in pieces that end at a given byte, dealt over tasks by ranges of each file."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pieces(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(file, place, length, piece): the bytes before each sep, in order within each byte range of a file; place is where the range begins, length the file's."""
    text = spark.read.option("lineSep", sep).text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("place"), F.col("_metadata.file_size").alias("length"), F.col("value").cast("binary").alias("piece"))


def lengths(spark: SparkSession, path: str) -> DataFrame:
    """(file, length) of the files of a path that hold a byte; their content is not read."""
    return spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("length"))


def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int, int], Iterator[list[bytes]]]]:
    """Each (file, place, length) of a task with its pieces, in lists of some thousand."""

    def lists() -> Iterator[tuple[tuple[str, int, int], list[bytes]]]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            others = pc.or_(*[pc.not_equal(c.slice(1), c.slice(0, n - 1)) for c in batch.columns[:2]])  # rows at which another range begins
            for at, end in pairwise([0, *(np.flatnonzero(others.to_numpy(zero_copy_only=False)) + 1).tolist(), n]):
                yield tuple(c[at].as_py() for c in batch.columns[:3]), batch.column(3).slice(at, end - at).to_pylist()

    for key, group in groupby(lists(), key=lambda x: x[0]):
        yield key, (x for _, x in group)
