"""Exact top-k search by the threshold algorithm over sorted per-dimension lists.

Rows are numbered and cut into blocks, queries into groups, and each pair of a block and a group is one bounded cell.  A
cell holds a list of its rows sorted by every dimension.  A query reads its lists from the end that is best under the
sign of its weight, some rows deeper in each turn, and scores the rows it meets for the first time.  The weights times the
values at the present depth bound the score of every row not met; once the k-th best score is above the bound, the
rest cannot enter (at an equal bound it goes on, since ties go to the smaller id).  The best of each cell meet in a rank
per query.

Defined cases: vectors that are null or hold a null, NaN or infinity take no part, nor do rows without id; a
query meets only vectors of its own length; repeated rows are rows of their own, and a query leaves out only its own row.
An empty vector scores 0 with every other.  Scores beyond 64 bits raise an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tarmac.operators.keys import dense_ids
from tarmac.session import cut_lineage

BLOCK_ROWS = 4096
GROUP_ROWS = 4096
_FIRST_DEPTH = 16


def scaled(vector: Column, factor: int = 1024) -> Column:
    """Components as floor(factor * x); null for a vector that takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(vector, lambda x: F.floor(F.lit(factor) * x.cast("double")))
    return F.when(~F.coalesce(bad, F.lit(True)), whole)


class SortedLists:
    """Rows of one block with a sorted list per dimension."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray) -> None:
        self.rows, self.ids = rows, ids
        self.order = np.argsort(rows, axis=0, kind="stable")
        self.values = np.take_along_axis(rows, self.order, axis=0)

    def best(self, weights: np.ndarray, k: int, own: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores of the k best rows but ``own``, best first."""
        n = len(self.rows)
        used = np.flatnonzero(weights)  # a weight of 0 adds nothing: its list needs no reading
        up, down = used[weights[used] < 0], used[weights[used] > 0]
        met = np.zeros(n, dtype=bool)
        if own is not None:
            met[own] = True
        found, scores = np.empty(0, dtype=np.int64), np.empty(0, dtype=self.rows.dtype)
        at, depth = 0, min(n, _FIRST_DEPTH)
        while True:
            turn = np.zeros(n, dtype=bool)
            if len(used):
                turn[self.order[at:depth, up].ravel()] = True
                turn[self.order[n - depth : n - at, down].ravel()] = True
            else:
                turn[at:depth] = True
            fresh = np.flatnonzero(turn & ~met)
            met |= turn
            found = np.concatenate((found, fresh))
            scores = np.concatenate((scores, self.rows[fresh] @ weights))
            if len(found) > k:
                kept = np.lexsort((self.ids[found], -scores))[:k]
                found, scores = found[kept], scores[kept]
            bound = self.values[depth - 1, up] @ weights[up] + self.values[n - depth, down] @ weights[down]
            if depth == n or met.all() or (len(found) == k and scores.min() > bound):
                kept = np.lexsort((self.ids[found], -scores))
                return found[kept], scores[kept]
            at, depth = depth, min(n, depth * 4)


def _matrix(batch: pa.Table, column: str) -> np.ndarray:
    flat = batch.column(column).combine_chunks()
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(batch.num_rows, -1) if batch.num_rows else values.reshape(0, 0)


def _largest(values: np.ndarray) -> int:
    return max((abs(int(values.min())), abs(int(values.max()))) if values.size else (0, 0))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vectors`` (``id`` bigint, ``vector`` array of bigint) in ``is_query``."""
    valid = vectors.where("id IS NOT NULL AND vector IS NOT NULL").select("id", "vector")
    numbered = cut_lineage(dense_ids(valid, ["id", F.xxhash64("vector")], "row", start=0))
    queries = cut_lineage(dense_ids(numbered.where(is_query), ["row"], "number", start=0))
    blocks, groups = -(-numbered.count() // block_rows), -(-queries.count() // group_rows)
    if not groups:
        blocks = 0
    cells = ["length", "block", "group"]
    rows = numbered.select(
        "id", "row", "vector", F.size("vector").alias("length"), F.floor(F.col("row") / block_rows).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(max(groups, 1) - 1))).alias("group"),
    )
    asked = queries.select(
        "id", "row", "vector", F.size("vector").alias("length"), F.floor(F.col("number") / group_rows).cast("int").alias("group"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(max(blocks, 1) - 1).cast("bigint"))).alias("block"),
    )
    schema = "query_id bigint, query_row bigint, vec_id bigint, row bigint, score bigint"
    names = [part.split()[0] for part in schema.split(", ")]

    def search(block: pa.Table, group: pa.Table) -> pa.Table:
        out = [np.empty(0, dtype=np.int64)] * 5
        if block.num_rows and group.num_rows:
            values, weights = _matrix(block, "vector"), _matrix(group, "vector")
            reach = _largest(values) * _largest(weights) * max(1, values.shape[1])
            if reach >= 1 << 62:
                raise OverflowError("scores exceed 64 bits")
            exact = np.float64 if reach < 1 << 52 else np.int64  # whole numbers below 2^53 are exact in float64
            values, weights = values.astype(exact), weights.astype(exact)
            ids, numbers = (block.column(c).to_numpy() for c in ("id", "row"))
            place = {row: i for i, row in enumerate(numbers.tolist())}
            lists = SortedLists(values, ids)
            parts = []
            for i, (query, row) in enumerate(zip(group.column("id").to_pylist(), group.column("row").to_pylist())):
                found, scores = lists.best(weights[i], k, place.get(row))
                n = len(found)
                parts.append((np.full(n, query), np.full(n, row), ids[found], numbers[found], scores.astype(np.int64)))
            out = [np.concatenate(column) for column in zip(*parts)]
        return pa.table([pa.array(c, pa.int64()) for c in out], names=names)

    found = rows.groupBy(*cells).cogroup(asked.groupBy(*cells)).applyInArrow(search, schema)
    found = cut_lineage(found)  # else the search would not be given columns that nobody asks the ranks for
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
