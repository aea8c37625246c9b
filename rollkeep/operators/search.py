"""Pages and name searches over the active version, and screening of large tables against a list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollkeep.functions.scalar import alias_search, name_matches
from rollkeep.operators.versions import pointer
from rollkeep.sources.scratch import stored

MOST = 1_000


def check_page(offset: int, limit: int) -> None:
    if offset < 0 or not 1 <= limit <= MOST:
        raise ValueError(f"offset {offset} must be 0 or more, limit {limit} from 1 to {MOST}")


def check_query(text: str) -> str:
    if not text or not text.strip():
        raise ValueError("the query is blank")
    return text


def with_search_columns(records: DataFrame) -> DataFrame:
    """records with primary_name_lower and alias_search, to be stored with them."""
    return records.withColumns({"primary_name_lower": F.lower("primary_name"), "alias_search": alias_search(F.transform("aliases", lambda a: a["name"]))})


def current(records: DataFrame, activations: DataFrame, source_list: str) -> DataFrame:
    """The records of a list's CURRENT version, as it is at the time of the call.

    The pointer is looked up once and becomes literals, so that all that is read from the result, however late and
    often, belongs to that one version, and only its partition is read.
    """
    now = pointer(activations.where(F.col("source_list") == source_list), "CURRENT").first()
    if now is None:
        return records.limit(0)
    return records.where((F.col("source_list") == source_list) & (F.col("publish_date") == F.lit(now.publish_date)) & (F.col("digest") == now.digest))


def page(rows: DataFrame, offset: int = 0, limit: int = 50, key: str = "fixed_ref") -> DataFrame:
    """One page in the text order of key; past the end it is empty."""
    check_page(offset, limit)
    return rows.orderBy(F.col(key).cast("string")).offset(offset).limit(limit)


def page_after(rows: DataFrame, last: str | None, limit: int = 50, key: str = "fixed_ref") -> DataFrame:
    """The page after the key `last`: as cheap deep in a list as at its beginning."""
    check_page(0, limit)
    rows = rows if last is None else rows.where(F.col(key).cast("string") > last)
    return rows.orderBy(F.col(key).cast("string")).limit(limit)


def total(rows: DataFrame) -> DataFrame:
    """The number of all matches, whatever the page shows."""
    return rows.agg(F.count(F.lit(1)).alias("total"))


def search(rows: DataFrame, query: str) -> DataFrame:
    """Rows (primary_name_lower, alias_search) whose primary name or an alias contains the query, whatever the case."""
    return rows.where(name_matches(F.col("primary_name_lower"), F.col("alias_search"), F.lit(check_query(query))))


SPACE = r"\s+"


def words_of(texts: DataFrame, text_id: str, text: str) -> DataFrame:
    """(id, word): the distinct lower-case words of each text, cut at white space."""
    return texts.select(F.col(text_id).alias("id"), F.explode(F.array_distinct(F.split(F.lower(text), SPACE))).alias("word")).where("word <> ''")


def vocabulary_of(words: DataFrame) -> DataFrame:
    """(word, n): the number of texts that hold each word."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _cut(column: str, size: int) -> Column:
    """The distinct grams of this size of a word; none if it is shorter."""
    n = F.length(column)
    return F.array_distinct(F.transform(F.when(n >= size, F.sequence(F.lit(1), n - size + 1)).otherwise(F.array().cast("array<int>")), lambda i: F.substring(column, i, F.lit(size))))


def met_needles(vocabulary: DataFrame, words: DataFrame, needles: DataFrame, needle: str, grams: int = 3) -> DataFrame:
    """(id, needle): texts (words: id, word) that may contain a needle, by its rarest word.

    A text that contains a needle has, for each of the needle's words, a word that contains it and so holds all its grams.
    A gram's texts, summed over the vocabulary (word, n), bound those of a word; the needle's word with the least bound is
    looked up, and a needle with a gram that no text has is dropped. So a word that needles and texts share costs nothing
    as long as each needle has a rarer one. Words shorter than a gram count only in needles that have no others.
    """
    wanted = needles.select(F.lower(needle).alias("needle")).where(F.col("needle").rlike(r"\S")).distinct()
    every = F.array_distinct(F.filter(F.split("needle", SPACE), lambda w: w != ""))
    long = F.filter("parts", lambda w: F.length(w) >= grams)
    parts = wanted.withColumn("parts", every).select("needle", F.explode(F.when(F.size(long) > 0, long).otherwise(F.col("parts"))).alias("part"))
    size = F.least(F.length("part"), F.lit(grams))
    tried = parts.select("needle", "part", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("part") - size + 1), lambda i: F.substring("part", i, size)))).alias("gram"))
    tried = stored(tried)  # its size is then known: where it is small, Spark sends it to the words' grams instead of shuffling these
    sizes = sorted(r[0] for r in tried.select(F.length("gram")).distinct().collect())  # from 1 to grams
    by_gram = vocabulary.select("word", "n", F.explode(F.concat(F.array().cast("array<string>"), *[_cut("word", n) for n in sizes])).alias("gram"))
    by_gram = stored(by_gram.join(tried.select("gram").distinct(), "gram", "left_semi"))  # read twice, cut once
    common = by_gram.groupBy("gram").agg(F.sum("n").alias("texts"))
    rarest = tried.join(common, "gram", "left").groupBy("needle").agg(F.min_by(F.struct("part", "gram"), F.struct("texts", "part", "gram")).alias("x"), F.bool_and(F.col("texts").isNotNull()).alias("met"))
    chosen = stored(rarest.where("met").select("needle", "x.part", "x.gram"))
    holding = by_gram.join(chosen.select("part", "gram").distinct(), "gram").where(F.contains("word", "part")).select("word", "part").distinct()
    asked = stored(holding.join(chosen.select("needle", "part"), "part").select("word", "needle"))
    return words.join(asked, "word").select("id", "needle").distinct()


def screen(texts: DataFrame, text_id: str, text: str, needles: DataFrame, needle: str, grams: int = 3) -> DataFrame:
    """(text_id, needle), each pair once: every text that contains a needle, whatever the case.

    Null texts contain nothing; null needles and such of white space only are left out; null ids match nothing. Texts and
    needles are cut at white space, and met_needles finds what to compare; only these pairs are. All joins are by equality;
    nothing is broadcast but what Spark measures as small.
    """
    words = words_of(texts, text_id, text)
    return confirmed(met_needles(stored(vocabulary_of(words)), words, needles, needle, grams), texts, text_id, text)


def confirmed(met: DataFrame, texts: DataFrame, text_id: str, text: str) -> DataFrame:
    """Of pairs (id, needle) those whose text contains the needle, each once."""
    met = stored(met)  # where it is small, it goes to the texts
    low = texts.select(F.col(text_id).alias("id"), F.lower(text).alias("low"))
    return low.join(met, "id").where(F.contains("low", "needle")).select(F.col("id").alias(text_id), "needle").distinct()
