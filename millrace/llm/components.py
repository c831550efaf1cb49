"""Connected components by alternating star steps, every step a join and an aggregate on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import finish


def _least(edges: DataFrame) -> DataFrame:
    """Least neighbour of each node; partial aggregation keeps a hub with very many edges cheap."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).withColumn("m", F.least("m", "u"))
    return both.where("v > u").join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    others = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`node` and `label` (the least node reachable) for every node on an edge but the labels themselves.

    Self loops and repeated edges are harmless, nulls are not allowed; no edges give an empty result.  Each round is
    written to the shared folder, so no lineage grows, and the rounds end when the edges are stars around the least
    nodes: two or three rounds for bushy groups, in the order of log(n) for chains.
    """
    edges = edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v"))
    while True:
        edges = finish(_small_star(_large_star(edges)).distinct(), "stars")
        # Done when every edge goes from a node with no other edge up to a centre.
        ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            edges.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        )
        ends = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not ends.where("up > 1 or (up = 1 and down = 1)").limit(1).count():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
