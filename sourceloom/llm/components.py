"""Connected components by alternating stars; every round is a grouping and a join of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sourceloom.llm.common import store


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links the neighbours of a node with its least neighbour: the larger ones (``large``) or the smaller ones."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    side = both if large else both.where("v < u")
    least = side.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = side.join(least, "u")
    linked = joined.where("v > u" if large else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        linked = linked.unionByName(least.select("u", F.col("m").alias("v")))
    return linked.where("u <> v").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node is either the centre of its edges or the leaf of one."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("leaf"), F.lit(1).alias("centre")))
    torn = ends.groupBy("id").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
    return not torn.where("leaf > 1 OR leaf = 1 AND centre = 1").limit(1).count()


def components(edges: DataFrame) -> DataFrame:
    """``id, label``: the least node of its component, for every node of ``edges(u, v)``.

    The stars are stored after each round under ``spark.checkpoint.dir``, so a lost
    executor costs no more than a round.  Nodes without edges are not listed.
    """
    edges = store(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _stars(edges):
        edges = store(_star(_star(edges, True), False), "star")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct())
