"""Connected components of a links table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import cut


def _mins(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _stars(edges: DataFrame) -> bool:
    """Has every node with a smaller neighbour only one of those, which itself has none?"""
    up, down = F.lit(1), F.lit(0)
    ends = edges.select(F.col("u").alias("node"), up.alias("up"), down.alias("down")).union(edges.select("v", down, up))
    of_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not of_node.agg(F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0]


def components(links: DataFrame) -> DataFrame:
    """(u, root) of every node in the written table ``links`` (a, b) that is not itself the smallest it reaches, which is ``root``.

    Each round points every node at the smallest neighbour of its neighbours, until all point at
    one that points nowhere; asking that is one aggregation, another round would be several.
    Rounds are written tables; only one answer a round comes to the driver. A node with
    many links is one aggregated minimum and an ordinary join, which Spark can split.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
    while True:
        round_trip = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = round_trip.join(_mins(round_trip), "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = cut(large.distinct(), "edges")
        # Every neighbour and the node itself point at the smallest neighbour.
        ends = F.when(F.col("v") > F.col("m"), F.array("u", "v")).otherwise(F.array("u"))
        small = large.join(_mins(large), "u").select(F.explode(ends).alias("u"), F.col("m").alias("v"))
        edges = cut(small.distinct(), "edges")
        if _stars(edges):
            return edges.withColumnRenamed("v", "root")
