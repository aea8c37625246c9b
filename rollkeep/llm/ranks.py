"""Row numbers over a whole sorted table: counted within partitions, each of which is told what stands before it."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeep.llm.common import OWN, checkpointed

BY, ROW = f"{OWN}by", f"{OWN}row"


class Numbered(NamedTuple):
    """frame: the rows with group (from 0, in order), place (from 0 in its group) and last (of its group); how many rows and groups there are."""

    frame: DataFrame
    rows: int
    groups: int


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[object, int, int]]:
    """(value, begin, end) of each stretch of rows with one value of the grouping column; null equals null."""
    coded = pc.run_end_encode(batch.column(batch.schema.get_field_index(BY)))
    begin = 0
    for value, end in zip(coded.values.to_pylist(), coded.run_ends.to_pylist(), strict=True):
        yield value, begin, end
        begin = end


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of what a partition holds, if it has rows."""
    part, groups, rows, first, now = TaskContext.get().partitionId(), 0, 0, 0, 0
    head = tail = kind = None
    for batch in batches:
        kind = batch.schema.field(BY).type
        for value, begin, end in _stretches(batch):
            if not groups or value != tail:
                groups, now = groups + 1, 0
            now += end - begin
            rows += end - begin
            if groups == 1:
                head, first = value, now
            tail = value
    if groups:
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([head], kind), pa.array([tail], kind), pa.array([groups]), pa.array([rows]), pa.array([now])], ["part", "head", "tail", "groups", "rows", "tail_rows"])


def numbered(rows: DataFrame, by: str | None, order: list[str]) -> Numbered:
    """Number rows in the order of by and order, nulls first, text by its UTF-8 bytes; without by all rows are one group.

    rows should be materialised, as they are read twice. They are dealt by ranges of (by, order), so that a group takes
    as many tasks as it has rows for; rows that tie are split as well, in any order. Each task counts its rows in one
    stream. The driver sees one row of counts for each partition. An empty table gives no rows.
    """
    kept = [f"`{c}`" for c in rows.columns]
    marked = rows.withColumns({ROW: F.monotonically_increasing_id(), BY: F.col(by) if by else F.lit(0)})
    keys = [F.col(c).asc_nulls_first() for c in (BY, *order, ROW)]
    dealt = checkpointed(marked.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*kept, BY))
    kind = dealt.schema[BY].dataType.simpleString()
    parts = dealt.select(BY).mapInArrow(_counts, f"part long, head {kind}, tail {kind}, groups long, rows long, tail_rows long").collect()
    parts.sort(key=lambda p: p.part)
    starts: dict[int, tuple[int, int, bool]] = {}
    group, carried = -1, 0
    for k, p in enumerate(parts):
        goes_on = k > 0 and parts[k - 1].tail == p.head
        group, done = (group, carried) if goes_on else (group + 1, 0)
        starts[p.part] = (group, done, k + 1 < len(parts) and parts[k + 1].head == p.tail)
        carried = p.tail_rows + (done if p.groups == 1 else 0)
        group += p.groups - 1

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, place, goes_on = starts.get(TaskContext.get().partitionId(), (0, 0, False))
        now, held = (), None  # one batch waits for the value that follows it
        for batch in batches:
            if not batch.num_rows:
                continue
            groups, places, last = (np.zeros(batch.num_rows, t) for t in (np.int64, np.int64, bool))
            for value, begin, end in _stretches(batch):
                if now and value != now[0]:
                    group, place = group + 1, 0
                    (last if begin else held[1])[begin - 1] = True
                groups[begin:end] = group
                places[begin:end] = np.arange(place, place + end - begin)
                now, place = (value,), place + end - begin
            if held:
                yield _with(*held)
            held = ([*batch.columns[:-1], pa.array(groups), pa.array(places)], last, [*batch.schema.names[:-1], "group", "place", "last"])
        if held:
            held[1][-1] = not goes_on
            yield _with(*held)

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields[:-1])
    return Numbered(dealt.mapInArrow(numbers, f"{names}, group long, place long, last boolean"), sum(p.rows for p in parts), group + 1)


def _with(columns: list[pa.Array], last: np.ndarray, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*columns, pa.array(last)], names)
