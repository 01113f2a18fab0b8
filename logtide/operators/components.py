"""Connected components of an undirected graph by alternating star contractions.

Kiveris et al., "Connected Components in MapReduce and Beyond" (SoCC 2014): each round hooks
neighbours to the smallest node they know, so long chains need few rounds. A round is two aggregations
with map-side combine, each with one join that adaptive execution can split when a node is hot. No edge
becomes two in a round, so duplicates are dropped once, at its end. Rounds end as soon as stars are all there is:
the driver keeps plans, stages and tasks in its memory, and a round that changes nothing would cost it as many as any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.scratch import materialize, shuffled


def _hook(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each node, joined back to the node's edges."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(shuffled(smallest), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = _hook(both).where(F.col("v") > F.col("u"))
    return moved.select(F.col("v").alias("u"), F.least("m", "u").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, move to the smallest of them."""
    child = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    return _hook(edges).select(child.alias("u"), F.col("m").alias("v"))


def _only_stars(links: DataFrame) -> bool:
    """Whether each node hangs on one node at most, and on none that itself hangs on another."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.agg(F.coalesce(F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))), F.lit(False))).first()[0]


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; a component is named by its least node."""
    links = edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    links = materialize(links.distinct(), "links")
    for _ in range(max_rounds):
        if _only_stars(links):
            break
        links = materialize(_small_star(_large_star(links)).distinct(), "links")
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
