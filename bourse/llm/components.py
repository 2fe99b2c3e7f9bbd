"""Connected components by alternating large-star and small-star rounds.

Each round joins the edges with the least neighbour of every node and
rewrites them towards it, until all edges lead straight to a root; the number
of rounds grows with the logarithm of the longest chain. All state is in staged
tables; the driver sees two numbers per round. The least neighbours are staged
before they are joined, so that the join has a plain shuffle on either side and
a node with very many edges can be split over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, unstage

MAX_ROUNDS = 64


def _settled(e: DataFrame) -> bool:
    """Whether every edge leads from a node with no other edge to a root."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("v", F.lit(0), F.lit(1)))
    ends = ends.groupBy("x").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    many, both = ends.agg(F.max("up"), F.max(F.least("up", "down"))).first()
    return many is None or (many == 1 and both == 0)


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)`` for every node that has an edge to another node;
    ``component`` is the least node it reaches. Null ends, loops and repeated
    edges count for nothing."""
    e = edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst)))
    e = stage(e.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if _settled(e):
            break
        both = e.union(e.select("v", "u"))
        least = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        roots = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(roots, "u").where(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(roots.select("u", F.col("m").alias("v"))).distinct())
        new = stage(small, "edges")
        unstage(e)
        unstage(least)
        e = new
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
