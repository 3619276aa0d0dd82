"""Connected components of large graphs by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcast.llm.common import stored


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node and component (the smallest node reachable) of every node of an edge that joins two different nodes.

    Each round ties the larger neighbours of a node to its smallest one, then a node's smaller neighbours to the
    smallest of them; it ends when a round changes nothing. Rounds are written tables, so lineage stays short; the
    minimum of a hub combines before the shuffle, and its edges are joined, never gathered.
    """
    now = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), "edges")
    seen = _fingerprint(now)
    while seen[0]:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").union(low).distinct()
        now = stored(small, "edges")
        last, seen = seen, _fingerprint(now)
        if last == seen:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
