"""Selection of raw rows to clean."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def latest(raw: DataFrame, id_column: str = "raw_id") -> DataFrame:
    """The row with the greatest id.

    The maximum is a scalar subquery over one column, and the scan gets it as a pushed filter, so only
    the row groups that may hold that id are read in full.
    """
    newest = raw.agg(F.max(id_column)).scalar()
    return raw.where(F.col(id_column) == newest)


def newest_per_source(raw: DataFrame, id_column: str = "raw_id", source: str = "source") -> DataFrame:
    """Each source's newest row, so a file landed twice counts once."""
    newest = raw.groupBy(source).agg(F.max(id_column).alias(id_column)).select(id_column)
    return raw.join(newest, id_column, "left_semi")


def choose(raw: DataFrame, backfill: bool, id_column: str = "raw_id") -> DataFrame:
    """Everything for a backfill, otherwise only the newest load."""
    return newest_per_source(raw, id_column) if backfill else latest(raw, id_column)
