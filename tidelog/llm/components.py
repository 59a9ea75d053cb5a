"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.session import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's neighbours (the larger, or the smaller ones and itself) to its smallest neighbour."""
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(low, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _stars_only(edges: DataFrame) -> bool:
    """Whether each larger node has one link, and no smaller node is the larger one of another link."""
    n, larger = edges.agg(F.count(F.lit(1)), F.count_distinct("a")).first()
    return n == larger and edges.select(F.col("b").alias("a")).join(edges.select("a"), "a", "left_semi").isEmpty()


def connected(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a``, ``b``): label is the smallest node of its component.

    Large-star and small-star steps are repeated until every node but the smallest of each component has
    one link, to that one. Each step is a grouping with partial results and a join, and is written to the
    shared folder.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(pairs.distinct(), "component-links")
    while not _stars_only(edges):
        edges = written(_star(_star(edges, True), False), "component-links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
