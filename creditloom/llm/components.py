"""Connected components by alternating star contractions, with the lineage cut in every round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """`links` (u, v: long) to (node, root): root is the smallest node reachable. Nodes without a link don't appear.

    Every round sends each node's larger neighbours to its smallest one (large star), then its smaller ones to the
    smallest (small star). Minima are taken by grouping, which combines before the shuffle, and brought back by
    a join, which Spark splits where a hub is hot; no list of neighbours is ever collected. The loop ends
    when the links no longer change.
    """
    edges = cut_lineage(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _signature(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("low"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("low").alias("v"))
        edges = cut_lineage(small.where("u <> v").distinct())
        if (now := _signature(edges)) == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", F.lit(1), "u"))).first())
