"""Connected components of an undirected graph given as links between numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.llm.common import stored


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs below one root, and no root below another node."""
    below = edges.select(F.col("u").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above"))
    above = edges.select(F.col("v").alias("x"), F.lit(0).alias("below"), F.lit(1).alias("above"))
    roles = below.unionByName(above).groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return not roles.where("below > 1 OR (below = 1 AND above = 1)").limit(1).count()


def _starred(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links (u, v) with u > v."""
    # large star: larger neighbours of u hang below the smallest node around u
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.where("u <> v")
    # small star: smaller neighbours of u, and u itself, hang below the smallest
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    return (
        large.join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .where("u <> v")
        .distinct()
    )


def components(links: DataFrame, first: str, second: str) -> DataFrame:
    """(node, component): the smallest number reachable, for every node with a link.

    Large-star and small-star steps in turn: each hangs nodes below the smallest neighbour, so the
    number of rounds grows with the logarithm of the longest chain. A node's links are never
    gathered: a step is a minimum per node, which combines before the shuffle, and a join. Every
    round is a table in the shared folder. Links with a null end, loops and repeats do not matter.
    """
    ends = links.select(F.col(first).alias("a"), F.col(second).alias("b")).where("a <> b")
    edges = stored(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "components")
    while not _stars(edges):
        edges = stored(_starred(edges), "components")
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
