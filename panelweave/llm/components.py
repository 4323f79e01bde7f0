"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.workspace import materialise


def _stars(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours, then every node with its smaller ones, are tied to the least node around."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("to").alias("b"))
    large = large.where("a != b").distinct()
    lowest = large.groupBy("a").agg(F.min("b").alias("to"))
    small = large.join(lowest, "a").select(F.when(F.col("b") == F.col("to"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("to").alias("b"))
    return small.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node that links reach, for each node of ``links`` (``a``, ``b``) but the roots.

    Each round is written to the shared folder; the rounds grow with the logarithm of the longest chain. Only one count
    and one sum a round come to the driver.
    """
    pairs = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    known, pairs = None, materialise(pairs, "links")
    while True:
        seen = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == known or not seen[0]:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        known, pairs = seen, materialise(_stars(pairs), "links")
