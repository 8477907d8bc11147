"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import staged


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest of its neighbours and itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(links: DataFrame) -> DataFrame:
    """Every node hands itself and its smaller neighbours to the smallest of them. Here a > b in every link."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(
        least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest node. ``links`` has long a and b.

    Rounds double the reach of a node, so their number grows with the logarithm of the longest chain. Each round is
    written to the shared folder. Rounds end when the links are stars: no node has two links up, none is both ends.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    while True:
        links = staged(_small_star(_large_star(links)), "stars")
        ups = links.groupBy("a").agg(F.count("*").alias("n"))
        if ups.where("n > 1").isEmpty() and links.join(links.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links between nodes: only the components that the links touch are worked on again."""
    own = found.select("node", "component")
    ends = links.join(own.select(F.col("node").alias("a"), F.col("component").alias("x")), "a", "left").join(
        own.select(F.col("node").alias("b"), F.col("component").alias("y")), "b", "left").select(
        F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
    merged = components(ends).select(F.col("node").alias("old"), F.col("component").alias("new"))
    moved = own.join(merged, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component"))
    first_seen = merged.join(own, F.col("old") == F.col("node"), "left_anti").select(F.col("old").alias("node"), F.col("new").alias("component"))
    return moved.unionByName(first_seen)
