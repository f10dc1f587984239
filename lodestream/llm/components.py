"""Connected components by alternating large and small stars, all in distributed tables.

After Kiveris et al., "Connected Components in MapReduce and Beyond" (SoCC 2014).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import hot_join, staged


def _star(pairs: DataFrame, keep_self: bool, total: int) -> DataFrame:
    """For each u with neighbours v: (v, least of u and its v). The minima are combined before the shuffle; a node with many neighbours isn't one task."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    out = hot_join(pairs, least, "u", "m", total, F.xxhash64("v")).select("u", "v", "m")
    if keep_self:
        return out.select("v", "m").union(least.select(F.col("u").alias("v"), "m")).filter("v <> m").distinct()
    return out.filter("v > u").select("v", "m").filter("v <> m").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Loops and repeated edges do no harm; without edges there are no rows. Each round writes its edges to the shared folder.
    """
    pairs = staged(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).filter("v <> m").distinct(), "edges")
    mark, total = None, pairs.count()
    while True:
        both = pairs.select(F.col("v").alias("u"), F.col("m").alias("v")).union(pairs.select(F.col("m").alias("u"), "v"))
        large = _star(both, False, 2 * total)
        small = _star(large.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")), True, total)
        pairs = staged(small, "edges")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("v", "m") % 2**40), F.max("v")).first()
        if now == mark:
            break
        mark, total = now, now[0]
    return pairs.select(F.col("v").alias("node"), F.col("m").alias("component")).union(
        pairs.select(F.col("m").alias("node"), F.col("m").alias("component")).distinct()
    )
