"""Blocked Bloom filters as small tables: built by aggregation, looked up by a broadcast join, all in SQL functions.

A filter has blocks of 2**15 bits, each one row with an array of 512 longs (4 KB). The number of blocks follows the
number of values, up to MOST, so what is broadcast is bounded by 16 MB; a fuller filter only lets more rows through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollkeep.llm.common import OWN, checkpointed

BITS = 15
MOST = 4_096


def blocks_for(values: int, bits_each: int = 16) -> int:
    """Blocks that give every value so many bits, within 1 and MOST."""
    return min(MOST, max(1, -(-values * bits_each >> BITS)))


def _cells(h: Column, blocks: int, places: int) -> list[Column]:
    """Cell numbers of a 64-bit hash: its block, from a second hash, and places in it from disjoint parts of the hash."""
    block = F.pmod(F.xxhash64(h), F.lit(blocks))
    return [F.shiftleft(block, BITS) + F.shiftrightunsigned(h, BITS * k).bitwiseAND((1 << BITS) - 1) for k in range(places)]


def _packed(cells: DataFrame) -> DataFrame:
    """(block, words) of set cells (cell: long)."""
    word = F.shiftright("cell", 6)
    bits = cells.groupBy(word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("cell") % 64).cast("int"))).alias("bits"))
    by_block = bits.groupBy(F.shiftright("word", BITS - 6).alias("block"))
    held = by_block.agg(F.map_from_entries(F.collect_list(F.struct((F.col("word") % (1 << (BITS - 6))).alias("at"), "bits"))).alias("held"))
    words = F.transform(F.sequence(F.lit(0).cast("long"), F.lit((1 << (BITS - 6)) - 1).cast("long")), lambda i: F.coalesce(F.try_element_at("held", i), F.lit(0).cast("long")))
    return held.select("block", words.alias("words"))


class Filter:
    """A filter of 64-bit hashes that rows may be tested against; written to the checkpoint folder once."""

    def __init__(self, cells: DataFrame, blocks: int, places: int) -> None:
        self.blocks, self.places = blocks, places
        self.rows = checkpointed(_packed(cells)).select(F.col("block").alias(f"{OWN}block"), F.col("words").alias(f"{OWN}words"))

    def mark(self, rows: DataFrame, h: str) -> DataFrame:
        """rows with maybe: false only where h is surely not in the filter. No shuffle of rows."""
        cells = _cells(F.col(h), self.blocks, self.places)
        joined = rows.withColumn(f"{OWN}block", F.shiftright(cells[0], BITS)).join(F.broadcast(self.rows), f"{OWN}block", "left")
        held = F.lit(True)
        for c in cells:
            place = c.bitwiseAND((1 << BITS) - 1)
            held = held & (F.call_function("bit_get", F.get(f"{OWN}words", F.shiftright(place, 6).cast("int")), (place % 64).cast("int")) == 1)
        return joined.withColumn("maybe", F.coalesce(held, F.lit(False))).drop(f"{OWN}block", f"{OWN}words")


def member_filter(hashes: DataFrame, values: int, places: int = 3) -> Filter:
    """The filter of the hashes (h: long); values: about how many there are."""
    blocks = blocks_for(values)
    return Filter(hashes.select(F.explode(F.array(*_cells(F.col("h"), blocks, places))).alias("cell")), blocks, places)


def repeat_filter(hashes: DataFrame, values: int, places: int = 2) -> Filter:
    """The filter of those hashes (h: long) that may occur more than once.

    A counting Bloom filter: every row counts in its cells, and cells counted twice or more are set. Counts are summed
    within each partition first. A hash that occurs once is let through only if others meet all its cells: with 16
    cells a row, about one in sixty.
    """
    blocks = blocks_for(values)
    cells = hashes.select(F.explode(F.array(*_cells(F.col("h"), blocks, places))).alias("cell"))
    return Filter(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("cell"), blocks, places)
