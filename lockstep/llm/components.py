"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node reachable.

    Each round points the larger neighbours of every node at its smallest one, then
    the smaller ones too; the distance to the root falls by a constant factor. The smallest
    neighbours are cut before the joins, which so deal both sides anew and split a node with very many neighbours.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:  # some rounds more than the logarithm of the largest component's size
        both = e.union(e.select("v", "u")).toDF("u", "v")
        low = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = cut(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select("v", "m").where("v <> m").union(least.select("u", "m")).toDF("u", "v").distinct()
        e = cut(small)
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    out = e.toDF("node", "root")
    return out.union(out.select("root", "root").distinct())
