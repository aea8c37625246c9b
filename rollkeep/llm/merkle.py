"""Operator 12: a Merkle manifest of a dataset, with a proof for every row, by pointer jumping.

Rows are leaves. In each group, in order, runs of 16 nodes become their hash until one is left; these subroots form a
tree over the groups in the same way. Every inner node points at its parent and holds the segment of siblings that leads
there. Joining the table with itself doubles the distance of all pointers and concatenates the segments, until every
node points at the root; leaves stay with their runs and jump last, with the whole path of their run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollkeep.llm.common import checkpointed
from rollkeep.llm.ranks import numbered

#: Nodes in a run are 1 << FAN; a node of 2 * FAN more levels below an ancestor is met in one share of it.
FAN = 4
DIGEST = 64
TOP = -1
PATH = "array<struct<at:int,others:string,top:boolean>>"


def part(value: Column) -> Column:
    """A value as it enters a hash: its UTF-8 byte count, a colon and the value; `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest_of(values: list[Column]) -> Column:
    """Lower-case hex SHA-256 of the parts of some values, one after another."""
    return F.sha2(F.concat(*map(part, values)), 256)


def _run_digest(kids: Column, field: str) -> Column:
    return F.sha2(F.array_join(F.transform(kids, lambda k: k[field]), ""), 256)


def _others(all_digests: Column, at: Column) -> Column:
    """The digests of a run, joined, without the one at a place."""
    return F.concat(F.substr(all_digests, F.lit(1), at * DIGEST), F.substr(all_digests, (at + 1) * DIGEST + 1, F.lit(1 << (FAN + 6))))


def _folded(start: Column, path: Column) -> Column:
    """The digest that a node with digest start gives at the end of a path of siblings."""
    return F.aggregate(path, start, lambda now, s: F.sha2(F.concat(F.substr(s.others, F.lit(1), s.at * DIGEST), now, F.substr(s.others, s.at * DIGEST + 1, F.lit(1 << (FAN + 6)))), 256))


def _together(tables: list[DataFrame]) -> DataFrame:
    """All rows of some tables in as many partitions as a shuffle makes: those of a union add up, level by level and jump by jump."""
    rows = reduce(DataFrame.unionByName, tables)
    return rows.coalesce(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _tree(nodes: DataFrame, most: int, top: bool) -> tuple[list[DataFrame], list[DataFrame]]:
    """(roots, links) of trees over nodes (tree, place, node, digest, height, last), most being the largest place: each level is one grouping by run.

    A tree whose only node has place 0 and is the last is done. links: node, up, path and height of every node below a root.
    """
    roots, links, level = [], [], 1
    while most > 0:
        alone = (F.col("place") == 0) & F.col("last")
        roots.append(nodes.where(alone))
        level += 1
        kid = F.struct("place", "node", "digest", "height")
        runs = nodes.where(~alone).groupBy("tree", F.shiftright("place", FAN).alias("place")).agg(F.sort_array(F.collect_list(kid)).alias("kids"), F.max("last").alias("last"), (F.max("height") + 1).alias("height"))  # a run has 16 nodes at most
        runs = checkpointed(runs.withColumns({"digest": _run_digest(F.col("kids"), "digest"), "node": F.struct(F.col("tree").alias("tree"), F.lit(level).alias("level"), F.col("place").alias("place"))}))
        joined = F.array_join(F.transform("kids", lambda k: k.digest), "")
        each = runs.select(F.col("node").alias("up"), joined.alias("all"), F.posexplode("kids").alias("at", "kid"))
        links.append(each.select(F.col("kid.node").alias("node"), "up", F.array(F.struct("at", _others(F.col("all"), F.col("at")).alias("others"), F.lit(top).alias("top"))).alias("path"), F.col("kid.height").alias("height")))
        nodes, most = runs.drop("kids"), most >> FAN
    return [*roots, nodes], links


def _jumped(links: DataFrame, steps: int) -> DataFrame:
    """links with up and path leading to the root, at most so many steps away, for every node, by self-joins that double the distance each time.

    An ancestor is met by at most 16 to the power of the distance; beyond two levels it stands in as many copies as keep
    256 for each, so that no key is hot.
    """
    rows, distance = checkpointed(links.withColumn("open", F.lit(True))), 1
    while distance < steps:
        copies = 1 << (FAN * max(0, distance - 2))
        over = rows.where(F.col("height") >= distance).select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("path").alias("more"), F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"))
        asked = rows.where("open").withColumn("copy", F.pmod(F.hash("node"), F.lit(copies)))
        met = asked.join(over, ["up", "copy"], "left")
        met = met.select("node", F.coalesce("next", "up").alias("up"), F.when(F.col("next").isNull(), F.col("path")).otherwise(F.concat("path", "more")).alias("path"), "height", F.col("next").isNotNull().alias("open"))
        rows, distance = checkpointed(_together([rows.where("not open"), met])), distance * 2
    return rows.select("node", "path")


def proofs(docs: DataFrame, fields: list[str], by: str, key: str, changed: tuple[str, Column, Column] | None = None) -> DataFrame:
    """key, leaf, subroot, root, path, others, folded_root and verified of every row.

    A leaf hashes the given fields. Rows of a group are ordered by key, then by leaf, so rows that tie give the same tree in
    any order; nulls come first, and a null group is a group. path: the segments (place in the run, the digests of its
    others, whether above a subroot) from the leaf to the root; others: the digests of all segments, joined.
    changed: (field, its tampered value, which rows are tampered); folded_root starts from the tampered leaf there, and
    verified tells whether it is the root; a null condition is false. An empty table gives no rows; other columns are not
    read. Groups of any size are split: rows are dealt by ranges, and runs have 16 rows at most.
    """
    leaf = digest_of([F.col(f"`{f}`") for f in fields])
    other = F.lit(None).cast("string")
    if changed:
        other = F.when(changed[2], digest_of([changed[1] if f == changed[0] else F.col(f"`{f}`") for f in fields]))
    leaves = checkpointed(docs.select(F.col(f"`{by}`").alias("by"), F.col(f"`{key}`").alias("key"), leaf.alias("leaf"), other.alias("other")))
    placed = numbered(leaves, "by", ["key", "leaf"])
    runs = placed.frame.groupBy(F.col("group").alias("tree"), F.shiftright("place", FAN).alias("place")).agg(F.sort_array(F.collect_list(F.struct("place", "key", "leaf", "other"))).alias("kids"), F.max("last").alias("last"))
    runs = runs.withColumn("single", (F.col("place") == 0) & F.col("last") & (F.size("kids") == 1))
    runs = checkpointed(runs.withColumn("node", F.struct("tree", F.lit(1).alias("level"), "place")))
    digest = F.when(F.col("single"), F.col("kids")[0].leaf).otherwise(_run_digest(F.col("kids"), "leaf"))
    most = runs.agg(F.max("place")).first()[0] or 0
    subroots, links = _tree(runs.select("tree", "place", "node", digest.alias("digest"), F.lit(0).alias("height"), "last"), most, False)
    tops = _together(subroots).select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"), "node", "digest", "height", (F.col("tree") == placed.groups - 1).alias("last"))
    roots, more = _tree(checkpointed(tops), placed.groups - 1, True)
    root = _together(roots).first()  # one row, or none of an empty table
    paths = _jumped(_together(links + more), len(links + more)) if links + more else None
    rows = runs.join(paths, "node", "left") if paths else runs.withColumn("path", F.lit(None).cast(PATH))
    rows = rows.select("single", F.coalesce("path", F.array().cast(PATH)).alias("up"), F.array_join(F.transform("kids", lambda k: k.leaf), "").alias("all"), F.posexplode("kids").alias("at", "kid"))
    own = F.when(F.col("single"), F.array().cast(PATH)).otherwise(F.array(F.struct("at", _others(F.col("all"), F.col("at")).alias("others"), F.lit(False).alias("top"))))
    rows = rows.select("kid.*", F.concat(own, "up").alias("path"))
    inside, above = F.filter("path", lambda s: ~s.top), F.filter("path", lambda s: s.top)
    rows = rows.withColumns({"subroot": _folded(F.col("leaf"), inside), "others": F.array_join(F.transform("path", lambda s: s.others), "")})
    folded = F.when(F.col("other").isNull(), _folded(F.col("subroot"), above)).otherwise(_folded(F.col("other"), F.col("path")))
    rows = rows.select(F.col("key").alias(key), "leaf", "subroot", F.lit(root.digest if root else None).cast("string").alias("root"), "path", "others", folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
