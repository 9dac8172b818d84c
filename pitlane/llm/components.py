"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.shared import forget, stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): each linked node with the smallest node that it reaches.

    Alternates the large-star and small-star steps: every node hands its
    neighbours to its smallest one, until each points at its component's
    smallest node, in a number of rounds that grows with the logarithm of the
    size. Only minima are gathered for a node, never lists of neighbours, so a
    node with very many links needs no more memory than others. Self-links,
    repeated links and links with a null end are ignored; an empty table gives
    an empty result."""
    edges = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where(links[a].isNotNull() & links[b].isNotNull() & (links[a] != links[b])).distinct())
    edges = stored(edges, "cc")
    before = _state(edges)
    while before[0]:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        last, edges = edges, stored(small.select("e.u", "e.v").where("u != v").distinct(), "cc")
        forget(last)
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
