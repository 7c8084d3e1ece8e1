"""Connected components of a link table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.tables import staged


def component_labels(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of the component, for every node of ``links`` (a, b).

    Large-star steps link the larger neighbours of a node to its smallest neighbour, small-star
    steps the smaller ones; the alternation ends when all edges lead to roots. Minima are combined
    before each shuffle, and each round is written out.
    """
    edges = staged(_ordered(links.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    while not _are_stars(edges):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(_ordered(small.unionAll(least.select("u", F.col("m").alias("v")))))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return staged(edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(roots))


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller node."""
    return edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one edge and no edge leads to a node that has another."""
    ends = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    inner = edges.select("v").join(ends.select(F.col("u").alias("v")), "v", "left_semi")
    return ends.where("n > 1").select("u").unionAll(inner).isEmpty()
