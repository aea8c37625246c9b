"""Operator 6 [native]: exact dedup by two passes with a Bloom filter between them.

Pass 1 counts hashes in the cells of a counting Bloom filter; cells that were met twice make the filter. Pass 2 tests
every row: rows that the filter lacks occur once and go straight through, and only the others are shuffled and grouped
by the whole SHA-256 of their text. Texts are read and hashed once; what follows works on narrow rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeep.llm.common import OWN, ascii_lower, checkpointed
from rollkeep.llm.filters import member_filter, repeat_filter


def copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, keep_id, group_size, kept and text_sha256 of each row: equal texts, A-Z lower-cased, form a group.

    Of a group the row with the largest key stays; keep_id is that key, group_size the number of rows.
    Null text counts as empty. A null key loses against any other; a group of null keys only keeps all its
    rows, with a null keep_id. Rows that repeat the largest key stay together. An empty table gives no rows.
    The filter is sized by the number of rows and broadcast, at most 16 MB; a fuller one only lets more rows be
    shuffled, results stay the same.
    """
    sha = F.unhex(F.sha2(ascii_lower(F.col(text)), 256)).alias("sha")
    rows = checkpointed(docs.select(F.col(key).alias("key"), sha)).withColumn("h", F.xxhash64("sha"))
    marked = repeat_filter(rows, rows.count()).mark(rows, "h")
    once = marked.where("not maybe").select("key", "sha", F.col("key").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    maybe = marked.where("maybe").select("key", "sha")
    groups = maybe.groupBy(F.col("sha").alias("name")).agg(F.max("key").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = checkpointed(groups)  # both sides of the join are then dealt by the join alone, and adaptive execution splits hot groups
    more = maybe.join(groups, F.col("sha") == F.col("name")).select("key", "sha", "keep_id", "group_size", F.col("key").eqNullSafe(F.col("keep_id")).alias("kept"))
    return once.unionByName(more).select(F.col("key").alias(key), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that copies keeps, with the columns of docs.

    Rows whose key names no dropped row, by a Bloom filter, stay where they are; only the others are shuffled, to be
    matched by key and text. Nulls, ties, repeated rows and empty tables as in copies.
    """
    gone = checkpointed(copies(docs, key, text).where("not kept").select(F.col(key).alias(f"{OWN}key"), F.unhex("text_sha256").alias(f"{OWN}sha")).distinct())
    rows = docs.withColumn(f"{OWN}h", F.xxhash64(F.col(key)))
    if "maybe" in docs.columns:
        rows = rows.withColumnRenamed("maybe", f"{OWN}aside")
    rows = member_filter(gone.select(F.xxhash64(f"{OWN}key").alias("h")), gone.count()).mark(rows, f"{OWN}h")
    asked = rows.where("maybe").withColumn(f"{OWN}mine", F.unhex(F.sha2(ascii_lower(F.col(text)), 256)))
    same = asked[key].eqNullSafe(gone[f"{OWN}key"]) & (asked[f"{OWN}mine"] == gone[f"{OWN}sha"])
    out = rows.where("not maybe").unionByName(asked.join(gone, same, "left_anti").drop(f"{OWN}mine"))
    return out.select([F.col(f"`{OWN}aside`").alias(c) if c == "maybe" else F.col(f"`{c}`") for c in docs.columns])
