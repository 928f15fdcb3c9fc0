"""Connected components of a graph given as edges, by alternating star rounds.

In a large-star round every node hands its smallest neighbour to its larger
neighbours, in a small-star round to its smaller ones; stars of smallest nodes
are what is left when nothing changes. Rounds grow with the logarithm of the
graph. Each round is two shuffles by node and is written to the shared folder,
so a lost executor repeats one round at most; a node with very many neighbours
is met by map-side minima and by adaptive skew joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def _large_star(pairs: DataFrame) -> DataFrame:
    """Larger neighbours of every node join the smallest of its neighbours and itself."""
    both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.where("v > u").join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and itself, join the smallest of them (``u > v`` in all pairs)."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    joined = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
    return joined.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    """Count and checksum of a set of edges."""
    return tuple(edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component`` of every node that has an edge; the component is its smallest node.

    Edges may repeat, run either way, or lead back to their node. NULL ends are
    no nodes. Without edges the result is empty.
    """
    ends = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    ends = written(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    pairs, state, before = ends.where("u > v"), None, ()
    while state != before:
        pairs = written(_small_star(written(_large_star(pairs), "large-star")), "small-star")
        before, state = state, _state(pairs)
    nodes = ends.select(F.col("u").alias("node")).union(ends.select("v")).distinct()
    joined = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.join(joined, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
