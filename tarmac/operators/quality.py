"""Constraint checks as jobs: each returns the offending keys or rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tarmac.functions.geometry import is_line
from tarmac.operators.merge import has_null
from tarmac.session import cut_lineage


def pk_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count; counted before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def delta_pk_violations(added: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``added`` that occur more than once in it and ``target`` together, with their row count.

    The least and greatest new value of each key column go into the scan of ``target``, which skips the row groups outside;
    of the rest only rows whose key is new are counted.
    """
    new = cut_lineage(added.select(*keys))
    near = target.select(*keys)
    for key in keys:
        near = near.where(F.col(key) >= new.agg(F.min(key)).scalar()).where(F.col(key) <= new.agg(F.max(key)).scalar())
    met = near.join(new.distinct(), keys, "left_semi")
    return pk_violations(new.unionByName(met), keys)


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.where(has_null(columns))


def fk_violations(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Referenced values the parent lacks, with the number of child rows; NULL is allowed.

    Child rows are counted per value first, so a value used by most rows costs one row in the join.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    known = parent.select(F.col(parent_key).alias(column))
    return used.join(known, column, "left_anti").select(column, "n_rows")


def geom_violations(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Rows whose geometry is not a line of at least two vertices."""
    return df.where(~is_line(F.col(geom)))


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that break no rule, and the others with the names of the rules they break in ``reasons``."""
    broken = reduce(lambda a, b: a | b, rules.values())
    reasons = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return df.where(~broken), df.where(broken).withColumn("reasons", reasons)


class ConstraintError(RuntimeError):
    """A published table breaks one of its constraints."""


def require_empty(violations: DataFrame, what: str) -> None:
    """Raise with a few examples when a check finds anything."""
    sample = violations.limit(5).collect()
    if sample:
        raise ConstraintError(f"{what}: {[row.asDict() for row in sample]}")
