"""Threshold search against all inner products."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tarmac.llm import topk


def search(spark, rows, k=10, **options):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    vectors = df.select(F.col("vec_id").alias("id"), topk.scaled(F.col("embedding")).alias("vector"))
    got = topk.top_k(vectors, F.col("id") % 100 == 0, k, **options).collect()
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got)


def single(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


def plain(rows, k=10):
    valid = [
        (i, [math.floor(1024 * single(x)) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, (query, weights) in enumerate(valid):
        if query % 100 == 0:
            scored = [
                (-sum(a * b for a, b in zip(weights, v)), i)
                for m, (i, v) in enumerate(valid)
                if m != n and len(v) == len(weights)
            ]
            out += [(query, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"block_rows": 70, "group_rows": 2}])
def test_equals_all_products(spark, options):
    rnd = random.Random(2)
    rows = [(i, [rnd.gauss(0, 0.3) for _ in range(8)]) for i in range(600)]
    rows += [(1000 + i, [0.25] * 8) for i in range(80)]  # ties
    rows += [(2000 + i, [rnd.choice([-1.0, 0.0, 1.0]) for _ in range(8)]) for i in range(150)]
    rnd.shuffle(rows)
    assert search(spark, rows, **options) == plain(rows)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (None, [9.0, 9.0]), (5, [1.0]), (6, [3.0, -1.0])]
    rows += [(100, None), (200, []), (7, []), (300, [0.0, 0.0])]
    assert search(spark, rows) == plain(rows)


def test_repeated_rows_and_fewer_than_k(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (5, [0.5, 0.5]), (5, [0.5, 0.5])]
    assert search(spark, rows, 3) == plain(rows, 3)


def test_large_components(spark):
    rows = [(0, [1e6, 3.0]), (1, [-1e6, 1.0]), (2, [2.0, 5.0])]
    assert search(spark, rows) == plain(rows)
    with pytest.raises(Exception, match="64 bits"):
        search(spark, [(0, [1e30]), (1, [1e30])])


def test_any_columns_of_the_result(spark):
    """Counting or taking one column asks the search for less than its result."""
    rows = [(i, [float(i % 7), 1.0]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = topk.top_k(df.select(F.col("vec_id").alias("id"), topk.scaled(F.col("embedding")).alias("vector")), F.col("id") % 100 == 0)
    assert found.count() == 30
    assert sorted(r["rank"] for r in found.select("rank").collect()) == sorted(list(range(1, 11)) * 3)


def test_no_rows_and_no_queries(spark):
    assert search(spark, []) == []
    assert search(spark, [(1, [1.0]), (2, [2.0])]) == []
