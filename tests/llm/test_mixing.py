"""Source mixing: targets by rounds, copies by prefix sums, and the rows of the mix."""

import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tarmac.llm import mixing


def plain_targets(sizes, weights=(1, 2, 3), cap=3):
    """Share by weight, stop at the cap, share the excess again, until nothing is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = Fraction(sum(sizes.values())), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        target = {s: Fraction(cap * sizes[s]) if s in full else rest * weight[s] / free for s in order}
        above = {s for s in order if target[s] > cap * sizes[s]}
        if not above:
            return target
        full |= above


def plan(make_docs, rows):
    docs = make_docs(rows)
    sized = docs.select("source", mixing.word_count(F.col("text")).alias("size"), "doc_id", F.xxhash64("text").alias("h"))
    return mixing.plan_mix(sized, ["doc_id", "h"]).collect()


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_copies(make_docs, seed):
    rnd = random.Random(seed)
    sources = [None, "", "z", "é", "b", "B", "small", "words "]
    rows = [(i, "w " * rnd.randrange(60), rnd.choice(sources[: 4 + seed * 2])) for i in range(600)]
    rows += [(1000 + i, "w", "small") for i in range(3)]
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    got = plan(make_docs, rows)
    assert len(got) == len(rows)
    want = plain_targets(dict(sizes))
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and 0 <= r.copies <= 3
        assert r.target == pytest.approx(float(want[r.source]))
        taken[r.source] += r.size * r.copies
    for source, target in want.items():
        assert abs(taken[source] - target) <= 60
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, plan(make_docs, rows)), key=str)


def test_words_are_split_at_ascii_space_only(spark):
    texts = [None, "", " \t\n\x0b\x0c\r", "a b\tc\nd\x0be\x0cf\rg", "a\u00a0b\u2003c", "one"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: r.n for r in df.select("i", mixing.word_count(F.col("text")).alias("n")).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 7, 4: 1, 5: 1}


def test_source_without_words_takes_nothing(make_docs):
    got = plan(make_docs, [(1, None, "a"), (2, "", "a"), (3, "x y", "b")])
    assert {r.doc_id: (r.target, r.copies * r.size) for r in got} == {1: (0.0, 0), 2: (0.0, 0), 3: (2.0, 2)}


def test_mix_returns_whole_rows(make_docs):
    rnd = random.Random(1)
    rows = [(i % 90 if i % 7 else None, "w " * rnd.randrange(1, 30), rnd.choice("abc")) for i in range(300)]
    rows += [(5, "same text", "a")] * 40 + [(6, None, "a")]
    docs = make_docs(rows).withColumns({"_hash": F.lit("x"), "copies": F.lit(1)})
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    out = Counter(map(tuple, mixed.collect()))
    given = Counter(map(tuple, docs.collect()))
    assert set(out) <= set(given)
    assert all(n <= 3 * given[row] for row, n in out.items())
    words = sum(len((row[1] or "").split()) * n for row, n in out.items())
    total = sum(len((row[1] or "").split()) * n for row, n in given.items())
    assert abs(words - total) <= 100


def test_empty(make_docs):
    assert plan(make_docs, []) == []
    assert mixing.mix_documents(make_docs([])).count() == 0
