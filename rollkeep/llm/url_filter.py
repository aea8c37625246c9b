"""Operator 8 [native]: URL filters by a sort-merge range join.

A rule (host, path) becomes the canonical key "com.example./path": the labels of its host reversed, each
closed by a dot, then its path. A page probes with one such key for each host above its own, so a rule fits
a page exactly if its key is a prefix of a probe, that is, if the probe lies in the interval that begins
at the rule's key and ends before the key's successor. Rule starts, rule ends and probes are sorted
together once; the sweep carries the top of the stack of open rules. As intervals of prefixes nest, the
stack is kept as a parent link for each rule: a start makes its rule the top, an end brings back the parent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollkeep.llm.common import OWN, checkpointed

#: Sorts after every character that a key may hold: the end of a prefix's interval.
LAST = "\U0010ffff\U0010ffff"


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty for null or without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty for null or without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def rules_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) of written rules."""
    if not rules:
        return spark.range(0).select(*[F.lit("").alias(c) for c in ("host", "path", "verdict")])
    written = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(("host", "path", "verdict"), rule, strict=True)]) for rule in rules])
    return spark.range(1).select(F.explode(written).alias("rule")).select("rule.*")


def breakpoints(rules: DataFrame) -> DataFrame:
    """(key, top, verdict): from each key on, the rule that is the top of the stack; null where the stack is empty.

    Of rules with the same host and path, block wins. Parents are found by an equi-join of each rule's proper
    prefixes with the rules' keys, so that no task holds all rules.
    """
    rules = rules.where("host is not null and path is not null").withColumn("host", F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rules = rules.select(F.concat(F.array_join(_labels(F.col("host")), "."), F.lit("."), "path").alias("key"), F.concat("host", "path").alias("rule"), "verdict")
    prefixes = rules.select("key", F.explode(F.sequence(F.lit(0), F.length("key") - 1)).alias("n")).select("key", F.substring("key", F.lit(1), F.col("n")).alias("prefix"))
    above = prefixes.join(rules.select(F.col("key").alias("prefix"), F.struct(F.length("key").alias("n"), F.col("rule"), F.col("verdict")).alias("up")), "prefix")
    above = above.groupBy("key").agg(F.max("up").alias("up"))
    nested = rules.join(above, "key", "left")
    starts = nested.select("key", F.lit(2).alias("kind"), F.length("key").alias("depth"), F.struct("rule", "verdict").alias("top"))
    ends = nested.select(F.concat("key", F.lit(LAST)).alias("key"), F.lit(1).alias("kind"), (-F.length("key")).alias("depth"), F.struct(F.col("up.rule").alias("rule"), F.col("up.verdict").alias("verdict")).alias("top"))
    return starts.unionByName(ends)


def top_rules(probes: DataFrame, rules: DataFrame) -> DataFrame:
    """probes (with a column key) with top: a struct (rule, verdict) of the longest rule whose key is a prefix, fields null without one.

    One range partitioning of rule ends and probes together; a key that many probes share is split over
    partitions by a hash of the row. A partition takes over the last top of those before it: one small row each.
    """
    columns = [c for c in probes.columns if c != "key"]
    marks = breakpoints(rules).select("key", "kind", "depth", "top", *[F.lit(None).cast(probes.schema[c].dataType).alias(c) for c in columns])
    events = marks.unionByName(probes.select("key", F.lit(3).alias("kind"), F.lit(0).alias("depth"), F.lit(None).cast(marks.schema["top"].dataType).alias("top"), *columns))
    n = int(probes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("key"), F.col("kind"), F.col("depth")]
    events = events.repartitionByRange(n, *order, F.xxhash64(*columns)).withColumn(f"{OWN}part", F.spark_partition_id())
    events = checkpointed(events)
    last = events.where("kind < 3").groupBy(f"{OWN}part").agg(F.max_by("top", F.struct("key", "kind", "depth")).alias(f"{OWN}before"))
    last = events.select(f"{OWN}part").distinct().join(last, f"{OWN}part", "left")
    # one row for each partition of the shuffle: a bounded window and broadcast
    carried = F.last(f"{OWN}before", True).over(Window.orderBy(f"{OWN}part").rowsBetween(Window.unboundedPreceding, -1))
    last = last.select(f"{OWN}part", carried.alias(f"{OWN}before"))
    sweep = Window.partitionBy(f"{OWN}part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = events.withColumn("top", F.last("top", True).over(sweep)).where("kind = 3").join(F.broadcast(last), f"{OWN}part", "left")
    return swept.select("key", *columns, F.coalesce("top", f"{OWN}before").alias("top"))


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """key, host, path, rule and verdict of each page.

    A rule fits its host and all subdomains, if the path starts with the rule's; the longest (host and path
    together; of equally long ones the one that sorts last) wins. Without a fitting rule, rule is null and verdict is `default`. A null
    url or one without :// has an empty host and path, which no rule fits. Repeated rows and null keys are
    judged one by one. An empty table gives no rows, no rules give the default.
    """
    rows = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    distinct = rows.select("host", "path").distinct()
    labels = _labels(F.col("host"))
    probes = distinct.where("host <> ''").withColumn("depth_", F.explode(F.sequence(F.lit(1), F.size(labels))))
    probes = probes.select("host", "path", F.concat(F.array_join(F.slice(labels, F.lit(1), F.col("depth_")), "."), F.lit("."), "path").alias("key"))
    found = top_rules(probes, rules).where("top.rule is not null")
    found = found.groupBy("host", "path").agg(F.max(F.struct(F.length("top.rule").alias("n"), F.col("top.rule").alias("rule"), F.col("top.verdict").alias("verdict"))).alias("best"))
    found = checkpointed(found)
    out = rows.join(found.select(F.col("host").alias(f"{OWN}h"), F.col("path").alias(f"{OWN}p"), "best"), (F.col("host") == F.col(f"{OWN}h")) & (F.col("path") == F.col(f"{OWN}p")), "left")
    return out.select(F.col(key), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
