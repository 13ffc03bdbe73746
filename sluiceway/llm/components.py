"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.staging import stage


def components(links: DataFrame) -> DataFrame:
    """``(node, root)``: the smallest node reachable over ``links(a, b)``, for every node of a link.

    Alternates the two star steps (each node's larger neighbours, then its smaller ones, move to its smallest), so the
    rounds grow with the logarithm of the component size. A star's centre is found by a minimum that combines before
    the shuffle and joined back, never gathered, so a centre with very many neighbours does not meet in one group.
    """
    edges = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "links"
    )
    if edges.isEmpty():
        return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
    while True:
        both = edges.union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("w"), F.least("v", "m").alias("m"))
        large = both.where("u > v").join(low, F.col("v") == F.col("w")).select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = stage(large.where("v <> u").distinct(), "star")
        low = large.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("w"), "m")
        joined = large.join(low, F.col("v") == F.col("w"))
        small = joined.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u")).union(low.select(F.col("w").alias("v"), F.col("m").alias("u")))
        small = stage(small.where("v <> u").distinct(), "star")
        # done when every node hangs on one root and no root hangs on anything
        ends = small.select("v", F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(small.select("u", F.lit(0), F.lit(1)))
        if ends.groupBy("v").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).where("hangs > 1 or hangs = 1 and holds = 1").isEmpty():
            return small.select(F.col("v").alias("node"), F.col("u").alias("root"))
        edges = small
