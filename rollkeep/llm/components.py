"""Connected components of an edge table, by repeated hooking to the smallest neighbour and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeep.llm.common import ROWS, fitted


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b): component is the smallest node that links reach.

    Each round joins every node to its smallest neighbour if that is smaller, follows these links to their roots, and
    replaces both ends of every edge by their roots; edges inside a joined group vanish. Only nodes smaller than all
    their neighbours remain, and following links doubles its reach each time, so both loops are short even for
    long chains. The driver sees only edge
    counts. Hot nodes are met by map-side minima and by adaptive splitting of skewed joins. Edges get fewer from round to
    round: what is stored has as many partitions as its rows need, and what fits in one is sent to the tasks that join it.
    Self-links and rows with a null end are ignored; no edges give no rows.
    """
    kind = edges.schema["a"].dataType
    pairs, left = fitted(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    found: DataFrame | None = None
    while left:
        ends = F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))
        near = pairs.select(F.explode(ends).alias("e")).select("e.node", "e.other")
        near = near.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("up"))
        near = _to_roots(*fitted(near))
        pairs = pairs.join(near.select(F.col("node").alias("a"), F.col("up").alias("ua")), "a")
        pairs = pairs.join(near.select(F.col("node").alias("b"), F.col("up").alias("ub")), "b").where("ua <> ub")
        pairs, left = fitted(pairs.select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct())
        if found is None:
            found = near.select("node", F.col("up").alias("component"))
        else:
            step = near.select(F.col("node").alias("component"), F.col("up"))
            found, _ = fitted(found.join(step, "component", "left").select("node", F.coalesce("up", "component").alias("component")))
    if found is None:
        return edges.sparkSession.createDataFrame([], f"node {kind.simpleString()}, component {kind.simpleString()}")
    return found


def _to_roots(near: DataFrame, nodes: int) -> DataFrame:
    """(node, up) with up replaced by where following it ends; up is never larger than node, and every up is a node. Ready to be joined."""
    sent = F.broadcast if nodes <= ROWS else lambda rows: rows
    while True:
        over = near.select(F.col("node").alias("up"), F.col("up").alias("top"))
        near, moved = fitted(near.join(sent(over), "up").select("node", F.col("top").alias("up"), (F.col("up") != F.col("top")).alias("moved")), "moved")
        if not moved:
            return sent(near.select("node", "up"))
