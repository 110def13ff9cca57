"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import cut_lineage


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a checksum that does not depend on their order."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``u``, ``v`` of one orderable type); ``root`` is the smallest node it reaches.

    Each round is an aggregate and a join and is stored, so nothing is gathered and a lost executor costs one round. A round
    keeps at most as many edges as it got; the number of rounds grows with the logarithm of the longest chain.
    """
    edges = cut_lineage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while (state := _state(edges)) != before:
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Stored, like the edges: Spark can then cut the join where one node has very many neighbours.
        low = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "lowest")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = cut_lineage(small.where("u <> v").distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
