"""Connected components of a graph that no single machine holds.

Alternating large-star and small-star steps: each hangs the neighbours of a node on their smallest
one, until every node hangs on the smallest node of its component. Each step is a grouped minimum
(combined before the shuffle) and a join; no neighbour list is ever collected, and a step ends in a
written table, from which adaptive execution can split a hub and a lost executor's work is redone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.tables import cut


def _hang(neighbours: DataFrame) -> DataFrame:
    """(u, v) rows with the smallest v of each u, or u itself if that is smaller, as ``low``."""
    low = cut(neighbours.groupBy("u").agg(F.least("u", F.min("v")).alias("low")), "low")
    return neighbours.join(low, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    return _hang(both).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    hung = _hang(edges)
    moved = hung.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.union(hung.select("u", F.col("low").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    """What tells one set of edges from another: its size and an order-free sum of hashes."""
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) to (node, root): every node of an edge and the smallest node reachable.

    Loops and repeated edges are ignored, rows with a NULL end too; a node with nothing but loops
    is not returned, and no edges give no rows.
    """
    apart = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    now, before = cut(apart.distinct(), "edges"), None
    while (mark := _mark(now)) != before:
        before = mark
        now = cut(_large_star(now).distinct(), "large")
        now = cut(_small_star(now).distinct(), "small")
    roots = now.select(F.col("v").alias("node")).distinct()
    return (
        now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        .union(roots.select("node", F.col("node").alias("root")))
        .distinct()
    )
