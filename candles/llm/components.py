"""Connected components of a graph that is larger than any one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candles.llm.common import stored


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of every node of `edges` (a, b): root is the smallest node reachable.

    Alternates the large star (larger neighbours are hung on the smallest node of the
    neighbourhood) and the small star (likewise the smaller ones) until all nodes hang on a root; a
    graph that comes so takes no round. Every step is an aggregate with partial sums and a join, so a node with very many neighbours is
    split like any skewed key; each round is a written table. The rounds grow with the logarithm
    of the longest chain. Self-links and repeated links are allowed, nulls link nothing; an empty
    graph has no rows.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = stored(links.where("a is not null and b is not null and u != v").distinct(), name)
    while not _stars(links):
        links = stored(_small_star(_large_star(links)), name)
    roots = links.groupBy("u").agg(F.min("v").alias("root"))
    return roots.select(F.col("u").alias("node"), "root").union(
        roots.select("root", "root").distinct())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    hung = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least).distinct()


def _stars(links: DataFrame) -> bool:
    """Whether every node hangs on one node, which hangs on none."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("hung"), F.lit(0).alias("lead")).union(
        links.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("hung").alias("hung"), F.max("lead").alias("lead"))
    return nodes.where(F.col("hung") + F.col("lead") > 1).isEmpty()
