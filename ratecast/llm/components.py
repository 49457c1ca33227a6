"""Connected components of an edge table, by rounds of hooking and pointer jumping on DataFrames."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_table


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a bigint, b bigint)`` -> (node, comp): the smallest node id of its component, for
    every node that has an edge.

    Large-star and small-star in turn: each node's neighbours are linked to the smallest of them, until
    the edges are stars (edges that are stars already need no round). Neighbour lists are never collected:
    each star step is an aggregate (the smallest neighbour of a node) joined back to the edges. Rounds grow
    with the logarithm of a component's diameter; each round is written to the shared folder.
    """
    e = scratch_table(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), "edges")
    while not _stars(e):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written, so that the join below is one of two tables, which Spark can split at the middle of a large star
        low = scratch_table(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "low")
        # large star: every larger neighbour of a goes to the smallest of a and its neighbours
        big = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        # small star: a and its smaller neighbours go to the smallest neighbour (a repeated edge does no harm before distinct)
        least = big.groupBy("a").agg(F.min("b").alias("m"))
        small = (big.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        e = scratch_table(small, "edges")
    return e.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def _stars(e: DataFrame) -> bool:
    """Whether every edge goes from a node of that edge alone to a node that no edge starts from."""
    ends = e.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.filter("up > 1 or (up > 0 and down > 0)").agg(F.count(F.lit(1))).first()[0] == 0
