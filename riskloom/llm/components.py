"""Connected components of an edge table by alternating large and small stars.

Each round keeps the components and flattens the trees towards their smallest node, so
a logarithmic number of rounds is enough; they end when all trees are flat. Minima are grouped (one partial row per task
and node, however hot the node), written to the shared folder and joined back, so the
join can split a hot node. Nothing is collected but one number a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored


def _flat(edges: DataFrame) -> bool:
    """True if every node has one edge downwards at most and none that is pointed at has."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("hit"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("hit")))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("hit").alias("hit"))
    return nodes.agg(F.count_if(F.expr("down > 1 OR down = 1 AND hit = 1"))).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v); root is the smallest node.

    Edges may repeat, point either way or be loops; nulls are ignored.
    """
    edges = edges.where("u IS NOT NULL AND v IS NOT NULL AND u != v")
    current = stored(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
        compact=True,
    )
    while not _flat(current):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(
            both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "minima", compact=True
        )
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u != v"), "large", compact=True)
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "minima", compact=True)
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = stored(
            small.unionByName(low.select("u", F.col("m").alias("v"))).where("u != v").distinct(),
            "edges",
            compact=True,
        )
    roots = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
