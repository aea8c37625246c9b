"""Operator 13: rows dealt to shards by a Feistel permutation of their global row numbers.

The permutation is a keyed bijection of the numbers 0 to n-1: a Feistel network permutes the next even power of two, and
numbers that leave the range walk on along their cycle until they are back. Shard and slot follow from the permuted
number alone, and so does the row from shard and slot, as the network runs backwards too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeep.llm.common import checkpointed
from rollkeep.llm.ranks import numbered

ROUNDS = 6
#: Odd multipliers of the round function.
MIX = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)
LOW = np.uint64(0xFFFFFFFF)


def half_bits(n: int) -> int:
    """Bits of each half of the network's numbers: the least that hold n numbers, so their range is below 4 n."""
    return max(1, -(-max(n - 1, 1).bit_length() // 2))


def round_keys(seed: int) -> list[int]:
    """One 32-bit key for each round."""
    return [(seed * MIX[0] + (k + 1) * MIX[1]) % (1 << 32) for k in range(ROUNDS)]


def _scrambled(half: np.ndarray, key: int, bits: int) -> np.ndarray:
    """The round function: products of 32-bit numbers with folds between them."""
    x = (half + np.uint64(key)) & LOW
    x = (x * np.uint64(MIX[1])) & LOW
    x ^= x >> np.uint64(15)
    x = (x * np.uint64(MIX[2])) & LOW
    x ^= x >> np.uint64(13)
    return x & np.uint64((1 << bits) - 1)


def _once(x: np.ndarray, keys: list[int], bits: int, back: bool) -> np.ndarray:
    left, right = x >> np.uint64(bits), x & np.uint64((1 << bits) - 1)
    for key in keys[::-1] if back else keys:
        if back:
            left, right = right ^ _scrambled(left, key, bits), left
        else:
            left, right = right, left ^ _scrambled(right, key, bits)
    return (left << np.uint64(bits)) | right


def permuted(numbers: np.ndarray, n: int, seed: int = 0, back: bool = False) -> np.ndarray:
    """The image of numbers below n under the permutation of 0 to n-1 that the seed names; back: its inverse. n is below 2**62."""
    keys, bits = round_keys(seed), half_bits(n)
    x = _once(numbers.astype(np.uint64), keys, bits, back)
    while (out := x >= n).any():  # numbers in range lie on every cycle, so each walk ends
        x[out] = _once(x[out], keys, bits, back)
    return x.astype(np.int64)


def shuffled(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", seed: int = 0) -> DataFrame:
    """key, size, text_crc32, row, shard and slot of every row; counts of shards are at most one apart.

    Row numbers follow key, then size, CRC-32 and a 64-bit hash of the text, so files and partitions do not matter; null
    keys come first, and rows that repeat take neighbouring numbers. size: the text's UTF-8 bytes plus 8; null text has
    none and the CRC-32 of empty text. Permuted number p goes to slot p // shards of shard p % shards. An empty table
    gives no rows. Texts are read once; only narrow rows are shuffled, and the driver sees counts alone.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = checkpointed(docs.select(F.col(f"`{key}`").alias("key"), (F.octet_length(whole) + F.lit(8)).cast("long").alias("size"), F.crc32(whole).alias("text_crc32"), F.xxhash64(whole).alias("h")))
    frame, n, _ = numbered(rows, None, ["key", "size", "text_crc32", "h"])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = permuted(batch.column(3).to_numpy(), n, seed)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((p % shards).astype(np.int32)), pa.array(p // shards)], [*batch.schema.names, "shard", "slot"])

    narrow = frame.select("key", "size", "text_crc32", F.col("place").alias("row"))
    dealt = narrow.mapInArrow(places, f"key {narrow.schema['key'].dataType.simpleString()}, size long, text_crc32 long, row long, shard int, slot long")
    return dealt.withColumnRenamed("key", key)


def row_of(shard: int, slot: int, n: int, shards: int, seed: int = 0) -> int:
    """The row number that stands at a slot of a shard, of n rows: computed, without a look at the table."""
    if not (0 <= shard < shards and 0 <= slot * shards + shard < n):
        raise ValueError("no such slot")
    return int(permuted(np.array([slot * shards + shard]), n, seed, back=True)[0])
