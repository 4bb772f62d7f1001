"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected to appear ``target / source size`` times.  Documents are ordered by size
within their source; the prefix sums of the expected copies, moved by one random offset per source, cross integers,
and a document is taken once per integer crossed.  Since neighbours in that order are of like size, the words taken
stay close to the target.  Documents of more than 1/64 of their source's words, at most 64 of them, are taken first; the
expected copies of the others are such that the source still expects its target.  The order is numbered by range partitions
and their counts, so a source with a third of all rows is spread like any other.

Defined cases: a null text has size 0; null is a source of its own and comes last; a source without words has
target 0 and takes nothing; ids may repeat or be null (rows that are equal in all columns share their copies).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarmac.llm.batches import small_batches
from tarmac.llm.names import numbered
from tarmac.operators.keys import dense_ids
from tarmac.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
_OFFSET_STEPS = 1 << 20  # offsets are multiples of 2^-20, so adding one to a whole number is exact
_HEAVY = 64  # documents above this part of their source's words go first
_SALTS = 32
_WIDE = "decimal(38,0)"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """``source, source_size`` with ``place`` (0, 1, ... by code point, null last) and ``target``.

    The whole of all sizes is shared by weight; a source stops at ``cap`` times its size and the excess goes to
    the others by weight, until none is above.  That is one level ``share / weight`` for all sources below their
    cap; each round sums the sources at their cap (one row to the driver) and raises the level.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    placed = dense_ids(sizes, [F.col("source").asc_nulls_last()], "place", start=0).withColumn(
        "weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int"))
    )
    placed = cut_lineage(placed)
    size, weight = F.col("source_size").cast(_WIDE), F.col("weight").cast(_WIDE)

    def sums(capped: Column):
        row = placed.agg(
            F.coalesce(F.sum(F.when(~capped, weight)), F.lit(0)).alias("weight"),
            (F.coalesce(F.sum(size), F.lit(0)) - cap * F.coalesce(F.sum(F.when(capped, size)), F.lit(0))).alias("left"),
        ).first()
        return int(row.left), int(row.weight)

    def at_cap(left: int, weights_left: int) -> Column:
        return (F.lit(cap * weights_left).cast(_WIDE) * size) <= (weight * F.lit(left).cast(_WIDE))

    state = sums(F.lit(False))
    while True:
        capped = at_cap(*state)
        following = sums(capped)
        if following == state or following[1] == 0:
            break
        state = following
    left, weights_left = state
    free = (weight * F.lit(left).cast(_WIDE)).cast("double") / F.lit(max(weights_left, 1)).cast("double")
    target = F.when(capped, (cap * size).cast("double")).otherwise(free)
    return placed.select("source", "source_size", "place", target.alias("target"))


def plan_mix(
    docs: DataFrame, keys: list[str], weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: int = 0
) -> DataFrame:
    """``keys`` of each row of ``docs`` with ``source, size, source_size, target`` and ``copies``.

    ``docs`` has ``source``, ``size`` and the ``keys`` that also order documents of one size; rows with equal
    keys are interchangeable.  ``seed`` chooses the random offset of each source.
    """
    light = cut_lineage(docs.select("source", "size", *keys))
    sizes = light.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    order = [F.col("source").asc_nulls_last(), F.col("size"), *[F.col(k).asc_nulls_last() for k in keys]]
    ordered = dense_ids(light, order, "position", start=0)
    ends = ordered.groupBy("source").agg(F.min("position").alias("first"), F.max("position").alias("last"))
    sources = source_targets(sizes, weights, cap)
    offset = F.pmod((F.col("place") + 1) * 668265263 + seed * 374761393, F.lit(_OFFSET_STEPS)) / F.lit(float(_OFFSET_STEPS))
    even = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    of_source = sources.join(ends.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    of_source = of_source.withColumns({"offset": offset, "expected": even}).withColumnRenamed("source", "s")
    of_source = cut_lineage(of_source)  # one row per source
    heavy = F.col("size") * _HEAVY > F.col("source_size")
    rows = _with_sources(ordered, of_source)
    by_heavy = _crossed(F.col("last") - F.col("position"), F.col("expected"))  # the largest first
    words = rows.groupBy("s").agg(
        F.coalesce(F.sum(F.when(heavy, F.col("size") * F.least(by_heavy, F.lit(cap)))), F.lit(0)).alias("taken"),
        F.coalesce(F.sum(F.when(~heavy, F.col("size"))), F.lit(0)).alias("light"),
    )
    rest = F.when(F.col("light") > 0, (F.col("target") - F.col("taken")) / F.col("light")).otherwise(F.lit(0.0))
    of_source = of_source.join(words.withColumnRenamed("s", "w"), F.col("s").eqNullSafe(F.col("w"))).drop("w")
    of_source = of_source.withColumn("rest", F.least(F.lit(float(cap)), F.greatest(F.lit(0.0), rest)))
    by_light = _crossed(F.col("position") - F.col("first"), F.col("rest"))
    copies = F.least(F.when(heavy, by_heavy).otherwise(by_light), F.lit(cap)).cast("bigint")
    return _with_sources(ordered, of_source).select(*keys, "source", "size", "source_size", "target", copies.alias("copies"))


def _with_sources(ordered: DataFrame, of_source: DataFrame) -> DataFrame:
    """Rows with the figures of their source; a salt lets many tasks join the rows of a hot one."""
    salted = of_source.withColumn("salt", F.explode(F.expr(f"sequence(0, {_SALTS - 1})")))
    same = F.col("source").eqNullSafe(F.col("s")) & (F.pmod("position", F.lit(_SALTS)) == F.col("salt"))
    return ordered.join(salted, same)


def _crossed(index: Column, expected: Column) -> Column:
    """Integers between the prefix sums of expected copies before and after a row, moved by the source's offset."""
    offset = F.col("offset")
    return F.floor((index + 1) * expected + offset) - F.floor(index * expected + offset)


def mix_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as its plan says, with the columns of ``docs``."""
    small_batches(docs.sparkSession)
    plain, names = numbered(docs)
    own = plain.withColumns({"key": F.col(names[key]), "hash": F.xxhash64(*plain.columns)})
    sized = own.select(F.col(names["source"]).alias("source"), word_count(F.col(names[text])).alias("size"), "key", "hash")
    plan = plan_mix(sized, ["key", "hash"], **options)
    units = plan.groupBy(F.col("key").alias("k"), F.col("hash").alias("h")).agg(
        F.sum("copies").alias("copies"), F.count("*").alias("equal")
    )
    joined = own.join(units.where("copies > 0"), (F.col("hash") == F.col("h")) & F.col("key").eqNullSafe(F.col("k")))
    # equal rows divide the copies of their group
    nth = F.row_number().over(Window.partitionBy("hash", "key").orderBy("hash", "key"))
    shared = joined.withColumn("nth", nth)
    copies = F.floor(F.col("copies") * F.col("nth") / F.col("equal")) - F.floor(
        F.col("copies") * (F.col("nth") - 1) / F.col("equal")
    )
    return (
        shared.withColumn("times", copies.cast("int"))
        .where("times > 0")
        .withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times"))))
        .select(*plain.columns)
        .toDF(*docs.columns)
    )
