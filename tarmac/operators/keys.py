"""Surrogate keys without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from tarmac.session import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def max_id(target: DataFrame, id_column: str) -> int:
    """Greatest id handed out so far, 0 for an empty table."""
    return target.agg(F.max(id_column)).first()[0] or 0


def dense_ids(df: DataFrame, order: list[str | Column], id_column: str, start: int = 1) -> DataFrame:
    """Consecutive ids in ``order`` from ``start``.

    Rows are range partitioned and sorted, each partition is counted, and the prefix sum over the
    counts (one row per partition) shifts the row numbers.  The ranged rows are written once before they
    are counted: range bounds come from a sample, so evaluating them twice could disagree.
    """
    ranged = cut_lineage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
            "_place", F.monotonically_increasing_id()
        )
    )
    numbered = ranged.select(
        *df.columns,
        F.shiftright("_place", _ROW_BITS).alias("_part"),
        F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # one row per partition: bounded by the task count, never by the data
    return numbered.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_row") + F.lit(start)).cast("bigint").alias(id_column), *df.columns
    )


def counted_ids(df: DataFrame, id_column: str) -> tuple[DataFrame, int]:
    """Ids 1 to n in the order read, and n: rows stay in their partitions, which are counted once they are written."""
    placed = cut_lineage(df.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", _ROW_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition
    offsets = cut_lineage(counts.select("_part", "_rows", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")))
    total = offsets.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = placed.join(F.broadcast(offsets), part == F.col("_part"))
    return numbered.select((F.col("_offset") + row + 1).cast("bigint").alias(id_column), *df.columns), total
