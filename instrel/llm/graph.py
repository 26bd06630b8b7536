"""Connected components by alternating stars, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from instrel.llm.common import stored


def _star(edges: DataFrame, both: DataFrame, keep) -> DataFrame:
    """Every kept neighbour of a node is tied to the smallest of the node and its neighbours."""
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(u, v)``; the component is its smallest node.

    Large and small stars take turns (Kiveris et al., "Connected components in MapReduce and beyond") until neither
    changes an edge. Each round keeps at most as many edges as there were, and a node with very many neighbours is
    only one side of an equi-join, which adaptive execution can split. Null ends and loops are left out.
    """
    edges = stored(
        edges.where("u is not null and v is not null and u <> v").select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_star(edges, both, F.col("v") > F.col("u")).distinct(), "edges")
        # Here every edge points down: u > v.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state or now[0] == 0:
            break
        state = tuple(now)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
