"""Connected components of a table of links by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.llm.scratch import land


def connect(links: DataFrame) -> DataFrame:
    """class, comp: every class of a link (a, b) and the smallest class it reaches.

    Each round hands neighbours to the smallest neighbour, first those that are larger, then those
    that are smaller; it ends when every link leads to its component's smallest member. A class
    with very many links is no problem: the smallest neighbour is an aggregate, and links are kept
    as rows. Every round is written, so a lost executor costs no earlier round."""
    edges = land(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .distinct(), "edges")
    while not _are_stars(edges):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = land(large.distinct(), "edges")
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = land(small.unionAll(down.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return edges.select(F.col("u").alias("class"), F.col("v").alias("comp")).unionAll(
        edges.select(F.col("v").alias("class"), F.col("v").alias("comp")).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether every class has one link down, to one that has none."""
    roles = edges.select("u", F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(
        edges.select("v", F.lit(0), F.lit(1)))
    per = roles.groupBy("u").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return per.where((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0))).isEmpty()
