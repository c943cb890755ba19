"""Connected components of a graph of longs, by alternating stars; every round is a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import keep


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b); root is the component's smallest node.

    Large star links a node's larger neighbours to its smallest neighbour, small star its smaller
    ones; hubs only meet in aggregates and joins, which Spark can split.
    """
    star = keep(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    before = _signature(star)
    while before[0]:
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        star = keep(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = _signature(star)
        if after == before:
            break
        before = after
    nodes = star.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(star.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
