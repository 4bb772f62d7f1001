"""Merkle manifest of a dataset: a tree of SHA-256 digests per group, and one over the groups.

A node is the hash of at most three consecutive nodes below it.  Leaves are numbered within their group and packed into
aligned blocks of ``3 ** levels``.  A block keeps each of its levels as one string of concatenated hex digests: substrings
of fixed width hash to the next level, and what stands beside a node in its run's substring is the sibling segment of a
proof.  The roots of the blocks are the leaves of the next round, until a group has one root; the groups' roots then form a
tree of the same kind.  On the way back every block hands the segments above it to its members.

A block has a bounded number of members whatever the size of its group, and the rounds grow with the logarithm of
the largest group.  Nothing but two counts reaches the driver.

Defined cases: a null field counts as ``-``; null is a group of its own and comes first; null keys come first in their
group; rows with equal keys follow each other by digest, and equal rows are leaves of their own; an empty table gives no
rows.  Columns that are neither fields, group nor key take no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarmac.operators.keys import dense_ids
from tarmac.session import cut_lineage

FAN = 3
LEVELS = 5  # of a block: 243 members
_HEX = 64
_ROW_MASK = (1 << 33) - 1  # monotonically_increasing_id counts the rows of a partition in its low 33 bits
_PATH = "array<struct<left:string,right:string>>"


def leaf(*fields: Column) -> Column:
    """Digest of a row's fields, each ``-`` if null, else its UTF-8 length, a colon and its value."""

    def part(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, fields)), 256)


def proof_digest(path: Column) -> Column:
    """Hash of all siblings on a path, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(node: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, node, lambda at, s: F.sha2(F.concat(s["left"], at, s["right"]), 256))


def manifest(
    docs: DataFrame,
    fields: list[str],
    group: str = "source",
    key: str = "doc_id",
    carry: dict[str, Column] | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """``group, key, leaf, subroot, root, path`` of every row of ``docs``, then the ``carry`` columns.

    ``path`` has a pair of ``left`` and ``right`` segments (hex digests, concatenated) per level, up to the root.
    """
    carried = carry or {}
    load = F.struct(F.col(key).alias("key"), *[c.alias(f"c{i}") for i, c in enumerate(carried.values())])
    leaves, trees = _placed(
        docs.select(F.col(group).alias("name"), load.alias("load"), leaf(*map(F.col, fields)).alias("node"))
    )
    n_trees, widest = trees.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    rounds = _up(leaves, widest, levels)
    tops = rounds[-1].select("tree", F.col("root").alias("node")).join(trees.select("tree", "name"), "tree")
    crown_rounds = _up(
        tops.select(
            F.lit(0).cast("bigint").alias("tree"),
            F.lit(n_trees).cast("bigint").alias("n"),
            F.col("tree").alias("pos"),
            "node",
            F.struct("name", F.col("node").alias("subroot")).alias("load"),
        ),
        n_trees,
        levels,
    )
    summit = crown_rounds[-1].select("tree", "block", F.expr(f"CAST(array() AS {_PATH})").alias("above"), F.col("root").alias("crown"))
    # one row per group, which its single topmost block receives
    crowns = cut_lineage(
        _down(crown_rounds, summit).select(
            F.col("pos").alias("tree"),
            F.lit(0).cast("bigint").alias("block"),
            F.col("path").alias("above"),
            F.struct("load.name", "load.subroot", F.col("crown").alias("root")).alias("crown"),
        )
    )
    return _down(rounds, crowns).select(
        F.col("crown.name").alias(group),
        F.col("load.key").alias(key),
        F.col("node").alias("leaf"),
        "crown.subroot",
        "crown.root",
        "path",
        *[F.col(f"load.c{i}").alias(name) for i, name in enumerate(carried)],
    )


def audit(docs: DataFrame, written: DataFrame, fields: list[str], key: str = "doc_id") -> DataFrame:
    """Rows of the manifest ``written`` with ``folded_root`` and ``verified``, from the present rows of ``docs``.

    A row whose key is gone has no ``folded_root`` and is not verified; a key that repeats is compared with each of its rows.
    """
    now = docs.select(F.col(key).alias("_key"), leaf(*map(F.col, fields)).alias("_leaf"))
    met = written.join(now, F.col(key).eqNullSafe(F.col("_key")), "left")
    root = F.when(F.col("_leaf").isNotNull(), fold(F.col("_leaf"), F.col("path")))
    return met.withColumn("folded_root", root).withColumn(
        "verified", F.coalesce(F.col("folded_root") == F.col("root"), F.lit(False))
    ).drop("_key", "_leaf")


def _placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves ``tree, n, pos, node, load`` and trees ``tree, name, n``: positions count from 0 in each group's order.

    Rows are range partitioned by group and key; what a group has in earlier partitions is the sum of one count per
    partition and group, and rows meet it by both, so a large group is met partition by partition.
    """
    order = [F.col("name").asc_nulls_first(), F.col("load.key").asc_nulls_first(), "node", "tie"]
    light = cut_lineage(rows.withColumn("tie", F.monotonically_increasing_id()))  # equal rows need not share a partition
    ranged = cut_lineage(
        light.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK)))
        .withColumn("part", F.spark_partition_id())
        .drop("tie")
    )
    earlier = Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = cut_lineage(
        ranged.groupBy("name", "part").agg(F.min("row").alias("first"), F.count("*").alias("rows"))
        .withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
        .withColumn("n", F.sum("rows").over(Window.partitionBy("name")))
    )
    trees = cut_lineage(dense_ids(runs.select("name", "n").distinct(), [F.col("name").asc_nulls_first()], "tree", start=0))
    runs = runs.join(trees.select(F.col("name").alias("t"), "tree"), F.col("name").eqNullSafe(F.col("t")))
    runs = runs.select(F.col("name").alias("r"), F.col("part").alias("p"), "first", "before", "n", "tree")
    leaves = ranged.join(runs, (F.col("part") == F.col("p")) & F.col("name").eqNullSafe(F.col("r")))
    return leaves.select("tree", "n", (F.col("row") - F.col("first") + F.col("before")).alias("pos"), "node", "load"), trees


def _up(nodes: DataFrame, widest: int, levels: int) -> list[DataFrame]:
    """The blocks of each round, lowest first; the last round has one block per tree."""
    width = FAN**levels
    rounds = [cut_lineage(_blocks(nodes, levels))]
    while widest > width:
        widest = -(-widest // width)
        below = rounds[-1]
        nodes = below.select(
            "tree", F.ceil(F.col("n") / width).alias("n"), F.col("block").alias("pos"), F.col("root").alias("node"),
            F.struct(F.lit(0).alias("none")).alias("load"),
        )
        rounds.append(cut_lineage(_blocks(nodes, levels)))
    return rounds


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """``tree, n, block, height, members, level0, level1, ..., root`` of every aligned block."""
    width = FAN**levels
    packed = nodes.groupBy("tree", "n", F.floor(F.col("pos") / width).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "node", "load"))).alias("members")
    )
    height = F.lit(levels)  # a tree of one block ends where one node is left
    for level in reversed(range(levels)):
        height = F.when(F.col("n") <= FAN**level, level).otherwise(height)
    found = packed.withColumn("height", height).withColumn("level0", F.array_join("members.node", ""))
    run = FAN * _HEX
    for level in range(levels):
        below = F.col(f"level{level}")
        runs = F.sequence(F.lit(0), F.floor((F.length(below) - 1) / run).cast("int"))
        above = F.array_join(F.transform(runs, lambda i: F.sha2(F.substr(below, i * run + 1, F.lit(run)), 256)), "")
        found = found.withColumn(f"level{level + 1}", F.when(F.col("height") > level, above).otherwise(below))
    return found.withColumnRenamed(f"level{levels}", "root")


def _down(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """``pos, node, load, path, crown`` of every leaf; ``above`` has path and crown of the topmost blocks."""
    members = None
    for blocks in reversed(rounds):
        levels = len([c for c in blocks.columns if c.startswith("level")])
        met = blocks.join(above, ["tree", "block"])

        def segments(member: Column, index: Column) -> Column:
            found = []
            for level in range(levels):
                at = F.floor(index / FAN**level).cast("int")
                nth, text = at % FAN, F.col(f"level{level}")
                left = F.substr(text, (at - nth) * _HEX + 1, nth * _HEX)
                right = F.substr(text, (at + 1) * _HEX + 1, (FAN - 1 - nth) * _HEX)
                found.append(F.struct(left.alias("left"), right.alias("right")))
            own = F.slice(F.array(*found), F.lit(1), F.col("height"))
            return F.struct(
                member["pos"].alias("pos"), member["node"].alias("node"), member["load"].alias("load"),
                F.concat(own, F.col("above")).alias("path"),
            )

        members = met.select("tree", "crown", F.inline(F.transform("members", segments)))
        above = members.select("tree", F.col("pos").alias("block"), F.col("path").alias("above"), "crown")
    return members
