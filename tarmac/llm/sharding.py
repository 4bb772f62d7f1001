"""Sharding by longest-processing-time scheduling: equal texts stay together, shards end up near equal in bytes.

Groups of equal texts larger than a small share of all bytes are scheduled one by one; there can only be a bounded number
of them.  The other groups are first gathered, whole, into a fixed number of bundles.  Both kinds, a bounded list,
are sorted by size and go to the least loaded shard through a heap; rows then learn their shard from a broadcast map
of that bounded size.  Slots are numbered over range partitions, so no shard is sorted in one task.

Defined cases: a null text counts 0 bytes, and null texts are one group; ids may repeat or be null; an empty table
gives no rows.  Two texts with the same 64-bit hash share a shard, which breaks nothing.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, functions as F

from tarmac.llm.names import numbered
from tarmac.operators.keys import dense_ids
from tarmac.session import cut_lineage

ROW_BYTES = 16


def schedule(items: list[tuple[int, int]], shards: int) -> dict[int, int]:
    """Longest first to the least loaded: ``(item, size)`` to shard.  Ties go to the smaller item and shard."""
    loads = [(0, shard) for shard in range(shards)]
    placed = {}
    for item, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, shard = loads[0]
        placed[item] = shard
        heapq.heapreplace(loads, (load + size, shard))
    return placed


def assign_shards(groups: DataFrame, shards: int, bundles: int = 4096) -> DataFrame:
    """Rows of ``groups`` (``group`` bigint, ``size``, other columns) with ``shard``.

    Groups above ``total / bundles`` are items of their own: fewer than ``bundles``.  With the bundles, at most
    ``2 * bundles`` items reach the driver.
    """
    spark = groups.sparkSession
    sizes = groups.groupBy("group").agg(F.sum("size").alias("size"))
    total = groups.agg(F.sum("size")).first()[0] or 0
    share = total // bundles
    heavy = sizes.where(F.col("size") > share).select("group", "size").collect()
    heavy = sorted((g.group, int(g.size)) for g in heavy)
    large = spark.createDataFrame([(group, i) for i, (group, _) in enumerate(heavy)], "group bigint, item int")
    bundle = (-1 - F.pmod("group", F.lit(bundles))).cast("int")  # bundles carry negative item numbers
    itemed = groups.join(F.broadcast(large), "group", "left").withColumn("item", F.coalesce("item", bundle))
    light = itemed.where("item < 0").groupBy("item").agg(F.sum("size").alias("size")).collect()
    items = [(i, size) for i, (_, size) in enumerate(heavy)] + [(b.item, int(b.size)) for b in light]
    placed = spark.createDataFrame(list(schedule(items, shards).items()), "item int, shard int")
    return itemed.join(F.broadcast(placed), "item").drop("item")


def shard_documents(docs: DataFrame, shards: int = 40, text: str = "text", key: str = "doc_id", bundles: int = 4096) -> DataFrame:
    """``key, size, text_crc32, shard, slot`` of every document; slots count from 0 within a shard.

    Within a shard, rows follow each other by group and ``key``.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    light = cut_lineage(
        docs.select(
            key,
            (F.octet_length(body) + ROW_BYTES).cast("bigint").alias("size"),
            F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
            F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.xxhash64(text)).alias("group"),
        )
    )
    assigned = cut_lineage(assign_shards(light, shards, bundles))
    order = [F.col("shard"), F.col("group"), F.col(key).asc_nulls_last(), F.col("text_crc32")]
    placed = dense_ids(assigned, order, "position", start=0)
    first = placed.groupBy("shard").agg(F.min("position").alias("first"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        key, "size", "text_crc32", "shard", (F.col("position") - F.col("first")).alias("slot")
    )


def write_shards(docs: DataFrame, path: str, shards: int = 40, text: str = "text", **options) -> None:
    """Write the rows of ``docs`` as Parquet folders ``shard=<n>`` by the same assignment.

    A column ``shard`` of ``docs`` is replaced.
    """
    docs = docs.drop("shard")
    plain, names = numbered(docs)
    body = F.col(names[text])
    hashed = plain.withColumns(
        {
            "group": F.when(body.isNull(), F.lit(0)).otherwise(F.xxhash64(body)),
            "size": (F.coalesce(F.octet_length(body), F.lit(0)) + ROW_BYTES).cast("bigint"),
        }
    )
    light = cut_lineage(hashed.groupBy("group").agg(F.sum("size").cast("bigint").alias("size")))
    of_group = assign_shards(light, shards, **options).select("group", "shard")
    placed = hashed.join(of_group, "group").drop("group", "size")
    placed.toDF(*docs.columns, "shard").write.partitionBy("shard").parquet(path)
