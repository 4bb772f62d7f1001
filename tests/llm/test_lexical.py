"""Lexical search against a plain scoring of every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(items, docs, k=10):
    listed = [(doc_id, Counter(terms(text)), len(terms(text))) for doc_id, text in docs]
    n_docs = sum(n > 0 for _, _, n in listed)
    total = sum(n for _, _, n in listed)
    df = Counter(term for _, counts, _ in listed for term in counts)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item_id, text in items:
        found = []
        for doc_id, counts, n in listed:
            if n:
                m = 100 - 75 + (75 * n * n_docs) // total
                score = sum(w[t] * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m)) for t in terms(text) if t in counts)
                if score > 0:
                    found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, doc_id, -score) for rank, (score, _, _, doc_id) in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1)]
    return sorted(out, key=repr)


@pytest.fixture
def ask(spark, make_docs):
    def run(items, docs, parts=3, **options):
        asked = spark.createDataFrame(items, "item_id bigint, text string")
        rows = lexical.search(asked, make_docs(docs).repartition(parts), **options).collect()
        return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows), key=repr)

    return run


def test_like_plain_scores(ask):
    rng = random.Random(1)
    words = ["the", "The", "an", "é", "Ünder", "ünder", "x1", "7", "rare", "日本", "a-b", "c_d", "e\x00f", "g\x85h", "i\xa0j"]

    def text(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choice(words) for _ in range(n))

    docs = [(i, text(rng.randint(0, 30))) for i in range(150)]
    docs += [(3, text(5)), (None, text(20)), (None, "rare rare"), (201, None), (202, ""), (203, "?!"), (204, "rare rare"), (205, "rare rare")]
    docs += [(300 + i, "rare the") for i in range(40)]  # ties beyond the last rank
    docs += [(400, "long text " * 100_000 + "rare")]
    items = [(i, text(rng.randint(1, 12))) for i in range(9)] + [(20, "rare"), (21, "absent"), (22, None), (23, ""), (None, "the")]
    want = plain(items, docs)
    assert ask(items, docs) == want
    assert ask(items, docs, parts=1, block_items=3) == want


def test_repeated_items_are_items_of_their_own(ask):
    docs = [(1, "one two"), (2, "two three")]
    assert ask([(5, "two"), (5, "two")], docs) == plain([(5, "two"), (5, "two")], docs)


def test_few_ranks(ask):
    docs = [(i, "x " * (i + 1) + "y") for i in range(30)]
    assert ask([(1, "x y")], docs, k=3) == plain([(1, "x y")], docs, k=3)


def test_empty_tables(ask):
    assert ask([], [(1, "a")]) == []
    assert ask([(1, "a")], []) == []
    assert ask([(1, "a")], [(1, None), (2, " ")]) == []


def test_other_columns_take_no_part(spark, make_docs):
    docs = make_docs([(1, "one two"), (2, "two")])
    items = spark.createDataFrame([(7, "two")], "item_id bigint, text string")
    want = lexical.search(items, docs).collect()
    for name in ("rank", "score", "item", "doc", "own", "n", "term"):
        docs, items = docs.withColumn(name, F.lit("x")), items.withColumn(name, F.lit("y"))
    assert lexical.search(items, docs).collect() == want


def test_large_scores_stay_exact():
    best = lexical.Best(1, 2)
    scores = np.array([[2**60 + 1], [2**60], [2**60 + 2]])
    best.add(scores, np.array([1, 2, 3]), np.zeros(3, dtype=bool))
    assert best.score.tolist() == [2**60 + 2, 2**60 + 1] and best.doc.tolist() == [3, 1]


def test_a_match_is_a_whole_term():
    block = lexical.ItemBlock.of([(0, "he hers she"), (1, "she she")])
    text = lexical.bounded("she hers ushers he,HE".encode())
    found = Counter(block.terms[i] for i in lexical.Scanner(block).hits(text))
    assert found == {b"she": 1, b"hers": 1, b"he": 2}
    assert lexical.count_terms(text) == 5
