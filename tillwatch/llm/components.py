"""Connected components of links between long ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import written


def _star_round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step; edges are (u, v) with u > v and stay so.

    Both steps take the smallest neighbour of each node by a partial aggregation and join
    it back to the edges, where Spark can split the partition of a node with many edges.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("low"))
    lower = large.join(least, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return lower.union(least.select("u", F.col("low").alias("v"))).distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge at most, to a node that has none of its own."""
    two = edges.groupBy("u").count().where("count > 1").select("u")
    chained = edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u")
    return two.union(chained).isEmpty()


def connected_components(links: DataFrame, left: str = "u", right: str = "v", max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of a link that is not the smallest of its component; ``root`` is the smallest.

    Nulls and links of a node to itself are left out. Each round is written to the shared
    folder, so the lineage stays short. A path of n nodes takes about log n rounds.
    """
    u, v = F.col(left).cast("long"), F.col(right).cast("long")
    edges = written(
        links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where(u.isNotNull() & v.isNotNull() & (u != v)).distinct(),
        "links",
    )
    for _ in range(max_rounds):
        if _all_stars(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges = written(_star_round(edges), "stars")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
