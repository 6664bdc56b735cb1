"""Connected components of links, as alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.text import staged


def _to_least(edges: DataFrame, include_self: bool) -> tuple[DataFrame, DataFrame]:
    """Edges with the least neighbour of ``u``, and that least neighbour by node. The minima are combined map-side and
    staged, so that the join sees two plain inputs and Spark can split a hot node."""
    least = F.least(F.min("v"), F.first("u")) if include_self else F.min("v")
    found = staged(edges.groupBy("u").agg(least.alias("m")), "least")
    return edges.join(found, "u"), found


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node, and that one none: then each star is a component."""
    ends = (edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("root"))
            .unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("root")))
            .groupBy("node").agg(F.sum("out").alias("out"), F.max("root").alias("root")))
    return ends.where((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("root") > 0))).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (longs ``u, v``); the label is the least node it is connected with.

    Large star: every greater neighbour of a node moves to the node's least neighbour. Small star: every smaller
    neighbour, and the node, do. Both keep the components and never add edges; rounds end when only stars are left.
    Their number grows with the logarithm of the nodes. Each round is staged.
    """
    edges = staged(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(),
                   "edges")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        joined, _ = _to_least(both, True)
        large = staged(joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        joined, least = _to_least(large, False)
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
