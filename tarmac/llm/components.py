"""Connected components by alternating large and small stars, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarmac.session import cut_lineage


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row.n, row.x


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``u``, ``v``); root is the smallest node reachable.

    Nodes never gather their neighbours: each round takes one minimum per node, combined before the shuffle, and
    joins it back.  Rounds grow with the logarithm of the longest path, and end when a round changes nothing.
    """
    edges = cut_lineage(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    before = _signature(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = cut_lineage(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(moved.unionByName(least.withColumnRenamed("m", "v")).distinct())
        after = _signature(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
