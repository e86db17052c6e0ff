"""Connected components of an undirected graph by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillworks.session import stored


# A node with more than this share of all links is looked up by broadcast: there are at most 2,000 such nodes.
HOT_SHARE = 1 / 1000
# Up to so many links a round is one job of three exchanges; all links of one node may meet in a task.
FEW_LINKS = 500_000


def _with_smallest(links: DataFrame, few: bool) -> DataFrame:
    """Links (u, v) with m, the smaller of u and its smallest neighbour.

    The smallest neighbours come from partial minima, so a node with very many links is one row per task. Its links
    do not meet under its key either: they get m from the short list of such nodes, where they are. ``few`` links go through
    one exchange by u instead.
    """
    if few:
        return links.withColumn("m", F.least("u", F.min("v").over(Window.partitionBy("u"))))
    smallest = stored(links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count("*").alias("degree")))
    total = smallest.agg(F.coalesce(F.sum("degree"), F.lit(0))).first()[0]
    hot = F.broadcast(smallest.where(F.col("degree") > total * HOT_SHARE).select("u", "m"))
    others = links.join(hot, "u", "left_anti").join(smallest.select("u", "m"), "u")
    return links.join(hot, "u").unionByName(others)


def _large_star(edges: DataFrame, few: bool) -> DataFrame:
    """Larger neighbours of each node are linked to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_smallest(both, few).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, few: bool) -> DataFrame:
    """Smaller neighbours of each node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    told = _with_smallest(down, few)
    moved = told.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(told.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple[int, bool]:
    """How many links there are, and whether every one leads straight to the smallest node of its component: one link a node,
    and none from a root."""
    ends = F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("links")), F.struct(F.col("v").alias("node"), F.lit(0).alias("links"))))
    nodes = edges.select(ends.alias("end")).groupBy("end.node").agg(F.sum("end.links").alias("links"), F.min("end.links").alias("least"))
    open_ones = F.count_if(F.expr("links > 1 OR (links > 0 AND least = 0)"))
    total, left = nodes.agg(F.coalesce(F.sum("links"), F.lit(0)), open_ones).first()
    return total, left == 0


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes`` (u) with the smallest node of their component (root); ``edges`` are pairs (u, v).

    Rounds grow with the logarithm of the longest path. Each is stored, so lineage stays short and a
    lost executor costs at most one round.
    """
    down = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = stored(down.distinct())
    while not (state := _state(current))[1]:
        few = state[0] <= FEW_LINKS
        current = stored(_small_star(_large_star(current, few), few).where("u <> v").distinct())
    roots = current.select("u", F.col("v").alias("root"))
    return nodes.join(roots, "u", "left").select("u", F.coalesce("root", F.col("u")).alias("root"))
