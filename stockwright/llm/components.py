"""Connected components of links between long ids, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwright.sources.tables import stage


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every id in ``links`` (``a, b``); a component is named by its smallest id.

    Each round makes every node point to the smallest id near it and is written, so a lost executor costs one round.
    Rounds grow with the logarithm of the longest chain. The smallest of a neighbourhood is a partial aggregate, so a
    node with very many links is no heavy group.
    """
    edges = stage(_ordered(links.select("a", "b")), "links")
    while True:
        # Large star: larger neighbours of a node to the smallest of its neighbourhood.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = _ordered(
            both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        # Small star: smaller neighbours of a node, and itself, to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        after = stage(_ordered(small), "links")
        if _same(edges, after):
            return _stars(after)
        edges = after


def _ordered(links: DataFrame) -> DataFrame:
    """Distinct links from the larger to the smaller id."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _same(before: DataFrame, after: DataFrame) -> bool:
    def digest(links: DataFrame):
        return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    return digest(before) == digest(after)


def _stars(links: DataFrame) -> DataFrame:
    own = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(own)
