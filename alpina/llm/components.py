"""Connected components of a link table, by alternating star contractions.

Every round each vertex passes its smallest neighbour on: first to its larger neighbours, then
to its smaller ones, until only stars around the smallest vertex are left (rounds grow with the logarithm
of the longest chain). All rounds are joins and aggregates over narrow rows; the driver sees one
yes or no per round. The minima are written before they are joined, so both join sides are plain
exchanges and adaptive execution splits a vertex that holds many of the links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alpina.llm.common import staged


def _all_stars(edges: DataFrame) -> bool:
    """Every vertex is either one that points to a single other, or one that others point to."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into")).filter("out + into > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(``id``, ``component``) of every vertex of ``links`` (``a``, ``b`` long); the smallest
    vertex names the component. Links from a vertex to itself count for nothing."""
    edges = staged(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .distinct(), "cc-links")
    while not _all_stars(edges):
        both = edges.union(edges.select("v", "u"))
        least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-least")
        large = staged(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .distinct(), "cc-large")
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.union(least).distinct(), "cc-links")
    roots = edges.select(F.col("v").alias("id")).distinct()
    return (edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .union(roots.select("id", F.col("id").alias("component"))))
