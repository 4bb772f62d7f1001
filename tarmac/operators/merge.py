"""Insert-only merge: an existing key always wins, and within a batch the first row per key wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, Window


def has_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def first_per_key(batch: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in ``order``.

    The rank filter becomes a group limit that runs before the shuffle, so even a key holding a third
    of the batch sends one row per input task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return batch.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def new_rows(
    batch: DataFrame,
    target: DataFrame,
    keys: list[str],
    order: list[Column],
    *,
    nullable_keys: bool = False,
) -> DataFrame:
    """Rows of ``batch`` an insert-only merge would add to ``target``.

    After the de-duplication both sides have unique keys and the anti join reuses its partitioning.
    Under ``nullable_keys`` a row with a NULL key part never conflicts and is always added, the way
    unique constraints treat NULL; primary keys do not admit such rows, so they are left out of the
    second branch by default.
    """
    keyed = batch.where(~has_null(keys))
    fresh = first_per_key(keyed, keys, order).join(target.select(*keys), keys, "left_anti")
    fresh = fresh.select(*batch.columns)
    if not nullable_keys:
        return fresh
    return fresh.unionByName(batch.where(has_null(keys)))


def insert_only_merge(
    batch: DataFrame,
    target: DataFrame,
    keys: list[str],
    order: list[Column],
    *,
    nullable_keys: bool = False,
) -> DataFrame:
    """Target after the merge."""
    added = new_rows(batch, target, keys, order, nullable_keys=nullable_keys)
    return target.unionByName(added)


def unseen_sources(batch: DataFrame, loaded: DataFrame, source: str = "source") -> DataFrame:
    """Batch rows whose source was not landed before."""
    return batch.join(loaded.select(source).distinct(), source, "left_anti").select(*batch.columns)
