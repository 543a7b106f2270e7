"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tools import stored


def _to_smallest(pairs: DataFrame) -> DataFrame:
    """``u, v`` with the smallest of ``u`` and all its ``v``; aggregated before the join, so a hub is one key there."""
    least = pairs.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("m"))
    least = stored(least.select("of", F.least("of", "m").alias("m")), "star-least")
    return pairs.join(least, F.col("u") == F.col("of")).select("u", "v", "m")


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of ``links (a, b)``, the component being its smallest node.

    Each round hangs larger neighbours, then smaller ones, below the smallest node in reach,
    until every component is a star. Links of a node to itself and nulls are ignored, repeated
    links count once.
    """
    edges = links.filter("a is not null and b is not null and a != b")
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "star-links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u != v").distinct(), "star-large")
        small = _to_smallest(large)
        small = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))).select("col.*")
        edges = stored(small.filter("u != v").distinct(), "star-small")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
