"""Records in key order with posting lists of their names' grams: pages and contains searches that read little.

Records stand in files by range of their key, and a small table of contents tells how many each holds, so a page opens the
files that it shows, and a comparison of two versions those that differ. A posting list names, for a gram and a file, the keys of the records whose names hold the gram; lists
are dealt to buckets by gram. A search reads the lists of its grams, intersects them file by file, and looks at those
records alone.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from rollkeep.functions.scalar import name_matches
from rollkeep.operators.compare import diff, record_hash
from rollkeep.operators.search import confirmed, met_needles, vocabulary_of, words_of
from rollkeep.sources.log import content_of, created, exists, names_in, put_batch

GRAM = 3
#: Records in a file, about; and records whose lists share a bucket, about.
IN_FILE, IN_BUCKET = 10_000, 20_000
#: Keys that a search passes to the scan of records as values; beyond that it joins.
GIVEN = 1_000


def grams(text: Column) -> Column:
    """The distinct grams of a text, in one walk over it; a shorter text is one gram, an empty one none."""
    n = F.length(text)
    every = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{GRAM}}}))"), F.lit(1))
    return F.array_distinct(F.when(n >= GRAM, every).when(n > 0, F.array(text)).otherwise(F.array().cast("array<string>")))


def buckets_of(words: list[str], buckets: int) -> list[int]:
    """The buckets of some grams, as the column function gives them."""
    return sorted({zlib.crc32(w.encode()) % buckets for w in words})


def write(records: DataFrame, folder: str, key: str = "fixed_ref") -> int:
    """Write records (key: text, not null; primary_name_lower, alias_search and any others) with their index; returns their number.

    Files are cut before keys whose hash says so, so that the same keys are cut alike in every version, and each file has a
    digest of its records that does not depend on their order: files that are equal in two versions are known without a
    look at them. Records that share a key stay together. Null names have no grams. An empty table gives an empty index.
    """
    spark = records.sparkSession
    cuts = [r[0] for r in records.where(F.pmod(F.crc32(key), F.lit(IN_FILE)) == 0).select(key).distinct().orderBy(key).collect()]  # one for each file but the first
    known = np.array(cuts, object)
    part_of = F.pandas_udf(lambda keys: pd.Series(np.searchsorted(known, keys.to_numpy(object), "right"), dtype="int32"), "int")
    # text is ordered by code point here and by UTF-8 byte in Spark, which is the same
    placed = records.withColumn("part", part_of(key) if cuts else F.lit(0))
    placed.repartition("part").sortWithinPartitions("part", key).write.partitionBy("part").parquet(f"{folder}/table=rows")
    rows = spark.read.schema(StructType([*records.schema.fields, StructField("part", IntegerType())])).parquet(f"{folder}/table=rows")
    columns = sorted(c for c in records.columns if c != key)
    one = F.concat_ws("-", F.col(key), record_hash(columns))
    digest = F.concat_ws("-", *[F.sum(F.xxhash64(one, F.lit(k)).cast("decimal(38,0)")).cast("string") for k in range(2)])
    contents = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"), F.max(key).alias("last"), digest.alias("digest")).orderBy("part").collect()  # one row for each file
    n = sum(r.n for r in contents)
    buckets = max(1, -(-n // IN_BUCKET))
    if n:
        held = rows.select(F.col("part").alias("file"), F.col(key).alias("key"), F.explode(F.array_distinct(F.concat(*[F.coalesce(grams(F.col(c)), F.array().cast("array<string>")) for c in ("primary_name_lower", "alias_search")]))).alias("gram"))
        lists = held.groupBy("gram", "file").agg(F.collect_set("key").alias("keys")).withColumn("part", F.pmod(F.crc32("gram"), F.lit(buckets)).cast("int"))
        lists.repartition(buckets, "part").sortWithinPartitions("part", "gram").write.partitionBy("part").parquet(f"{folder}/table=grams")
    about = {"key": key, "buckets": buckets, "schema": records.schema.json(), "files": [[r.part, r.n, r["first"], r["last"], cuts[r.part - 1] if r.part else None, r.digest] for r in contents]}
    created(spark, f"{folder}/_contents.json", json.dumps(about))
    return n


def differing(old: Index, new: Index) -> tuple[list[int], list[int]]:
    """The files of two indexes that are not equal in both: cut at the same key, with as many records and the same digest."""
    told = [{(cut, n, digest): file for file, n, _, _, cut, digest in x.files} for x in (old, new)]
    return tuple(sorted(file for about, file in mine.items() if about not in other) for mine, other in (told, told[::-1]))


def changes(old: Index, new: Index) -> DataFrame:
    """(key, change) as operators.compare.diff gives them for all records of two versions, from the files that are not equal in both."""
    mine, yours = differing(old, new)
    columns = sorted(c for c in new.schema.names if c != new.key)
    return diff(old.rows(mine).drop("part"), new.rows(yours).drop("part"), new.key, columns)


class Index:
    """What write has written, opened."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        about = json.loads(content_of(spark, f"{folder}/_contents.json"))
        self.spark, self.folder, self.key, self.buckets, self.files = spark, folder, about["key"], about["buckets"], about["files"]
        self.schema = StructType.fromJson(json.loads(about["schema"]))

    def rows(self, files: list[int] | None = None) -> DataFrame:
        """All records, or those of some files."""
        kind = StructType([*self.schema.fields, StructField("part", IntegerType())])
        found = self.spark.read.schema(kind).parquet(f"{self.folder}/table=rows") if self.files else self.spark.createDataFrame([], kind)
        return found if files is None else found.where(F.col("part").isin(files))

    def total(self) -> int:
        return sum(n for _, n, *_ in self.files)

    def page(self, offset: int, limit: int) -> DataFrame:
        """A page of all records in the text order of the key: from the files that hold it, however deep it is."""
        shown, before, skipped = [], 0, 0
        for file, n, *_ in self.files:
            if before + n <= offset:
                skipped = before + n
            elif before < offset + limit:
                shown.append(file)
            before += n
        return self.rows(shown).drop("part").orderBy(self.key).offset(offset - skipped).limit(limit)

    def page_after(self, last: str | None, limit: int) -> DataFrame:
        """The page after a key."""
        shown, held = [], 0
        for file, n, first, end, *_ in self.files:
            if (last is None or end > last) and held < limit:
                shown.append(file)
                held += n if last is None or first > last else 0
        rows = self.rows(shown).drop("part")
        return (rows if last is None else rows.where(F.col(self.key) > last)).orderBy(self.key).limit(limit)

    def _lists(self, asked: list[str]) -> DataFrame:
        lists = self.spark.read.schema("gram string, file int, keys array<string>, part int").parquet(f"{self.folder}/table=grams")
        return lists.where(F.col("part").isin(buckets_of(asked, self.buckets)) & F.col("gram").isin(asked))

    def candidates(self, query: str) -> DataFrame:
        """(file, keys) of the records that hold every gram of a lower-case query; for one shorter than a gram, of those with a gram that holds it."""
        if len(query) < GRAM:
            lists = self.spark.read.schema("gram string, file int, keys array<string>").parquet(f"{self.folder}/table=grams").where(F.contains("gram", F.lit(query)))
            return lists.select("file", F.explode("keys").alias("key")).groupBy("file").agg(F.collect_set("key").alias("keys"))
        asked = sorted({query[i : i + GRAM] for i in range(len(query) - GRAM + 1)})
        met = self._lists(asked).groupBy("file").agg(F.array_sort(F.collect_list(F.struct(F.size("keys").alias("n"), "keys"))).alias("lists"))  # one list for each gram of the query
        met = met.where(F.size("lists") == len(asked))
        common = F.aggregate(F.slice("lists", F.lit(2), F.size("lists")), F.col("lists")[0]["keys"], lambda now, x: F.array_intersect(now, x["keys"]))
        return met.select("file", common.alias("keys")).where(F.size("keys") > 0)

    def search(self, query: str) -> DataFrame:
        """The records whose primary name or an alias contains the query, whatever the case; all columns.

        Few candidates are looked up by their keys in their files; many are joined, so the driver never sees more than GIVEN.
        """
        low = query.lower() if query.isascii() else self.spark.range(1).select(F.lower(F.lit(query))).first()[0]
        rows = self.rows()
        if not self.files:
            return rows.drop("part")
        found = self.candidates(low).select("file", F.explode("keys").alias("key"))
        few = found.take(GIVEN + 1)
        if len(few) <= GIVEN:
            rows = rows.where(F.col("part").isin(sorted({r.file for r in few})) & F.col(self.key).isin([r.key for r in few]))
        else:
            rows = rows.join(found.select(F.col("file").alias("part"), F.col("key").alias(self.key)), ["part", self.key], "left_semi")
        return rows.where(name_matches(F.col("primary_name_lower"), F.col("alias_search"), F.lit(query))).select(*self.schema.names)


class TextIndex:
    """The words of texts, kept for screening them again and again: each text is cut into words once, whatever lists are asked for later.

    A batch of texts is added once, with the number of texts that hold each of its words. Words are written by the tasks
    that cut them, in the order of their texts, so the work is dealt as the texts are.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 16) -> None:
        """buckets is not used any more: dealing words to so few left all the sorting and writing to as few tasks."""
        self.spark, self.folder = spark, folder

    def add(self, texts: DataFrame, text_id: str, text: str, batch: str) -> bool:
        """Add texts as a batch of this name; False, and nothing is added, if it is there already. A text's id stands in one batch only."""
        if exists(self.spark, f"{self.folder}/batch={batch}"):
            return False
        words = words_of(texts, text_id, text)
        count = lambda at: vocabulary_of(self.spark.read.schema(words.schema).parquet(f"{at}/table=words"))
        return put_batch({"words": words, "vocabulary": count}, self.folder, batch)

    def _table(self, name: str, asked: list[str] | None = None) -> DataFrame | None:
        """A table of all batches, or of some, that are there at the time of the call."""
        batches = [n for n in names_in(self.spark, self.folder) if n.startswith("batch=") and (asked is None or n.removeprefix("batch=") in asked)]
        return self.spark.read.option("basePath", self.folder).parquet(*[f"{self.folder}/{b}/table={name}" for b in batches]) if batches else None

    def screen(self, texts: DataFrame, text_id: str, text: str, needles: DataFrame, needle: str, batches: list[str] | None = None) -> DataFrame:
        """(text_id, needle) as operators.search.screen gives them for the texts that were added, or for those of some batches; texts holds these, and only candidates' texts are looked at."""
        words = self._table("words", batches)
        if words is None:
            return confirmed(texts.select(F.col(text_id).alias("id"), F.lit("").alias("needle")).limit(0), texts, text_id, text)
        vocabulary = self._table("vocabulary", batches).groupBy("word").agg(F.sum("n").alias("n"))
        return confirmed(met_needles(vocabulary, words.select("id", "word"), needles, needle), texts, text_id, text)
