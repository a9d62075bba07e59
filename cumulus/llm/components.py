"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum (combined map-side) and an equi-join on
stored tables, so no adjacency list is ever gathered and a node with very
many links is split by the skew join. Steps repeat until the edge set stops
changing; their number grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _digest(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def _star(edges: DataFrame, name: str) -> DataFrame:
    """Every row (u, v) with the smallest of u and all its v."""
    low = stored(edges.groupBy("u").agg(F.min("v").alias("m")), name)
    return (edges.join(low, "u")
            .select("u", "v", F.least("u", "m").alias("m")))


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) for every node on an edge; component is its smallest node.

    Null ends and self-loops link nothing. No edges give no rows.
    """
    hi, lo = F.greatest(u, v), F.least(u, v)
    cur = stored(edges.filter((F.col(u) != F.col(v))).select(hi.alias("u"), lo.alias("v")).distinct(), "cc")
    seen = _digest(cur)
    while seen[0]:
        both = stored(cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v"))), "cc-both")
        large = stored(_star(both, "cc-low").filter("v > u and v != m")
                       .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-large")
        low = _star(large, "cc-low")
        small = (low.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v")))).distinct()
        cur = stored(small, "cc")
        now = _digest(cur)
        if now == seen:
            break
        seen = now
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
