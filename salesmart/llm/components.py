"""Connected components of an edge table by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import skewed_join, stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over `edges`, for every node of an edge.

    Each round moves edges to smaller nodes without losing reachability, first from each node
    to its larger neighbours, then to its smaller ones; it ends when all edges form stars around
    the smallest nodes. Rounds grow with the logarithm of a component's size. Each is written
    out, which cuts the lineage. A hub's edges stay where they are read, whatever their number. Loops and repeated edges have no effect; null ends are dropped.
    """
    ends = [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]
    known = F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    edges = stored(edges.where(known).select(*ends).distinct(), "edges")
    while not _is_stars(edges):
        edges = stored(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _is_stars(edges: DataFrame) -> bool:
    """Whether each node has one edge up at most and no node is both above and below."""
    above = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    if above.where("n > 1").limit(1).count():
        return False
    middle = edges.select("u").join(edges.select(F.col("v").alias("u")), "u", "left_semi")
    return middle.limit(1).count() == 0


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v", F.lit(0).alias("up")).union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"), F.lit(1)))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.sum("up").alias("n"))
    larger = skewed_join(edges.select(F.col("v").alias("u"), F.col("u").alias("v")), stored(least.where("n > 0"), "least"), "u", "n")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    edges = stored(edges, "large")
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "least")
    smaller = skewed_join(edges, least, "u", "n").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return smaller.union(own).where("u != v").distinct()
