"""SimHash near-duplicates against brute force, and the split of hot buckets."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tarmac.llm import simhash


def brute_print(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest id reachable, of (id, print) rows with distinct ids."""
    root = {i: i for i, _ in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(prints):
        for j, b in prints[:n]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: find(i) for i, _ in prints}


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "A b", "É é A a\x0bb c", "x y z " * 500, "a b c d e"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % 2**64 == brute_print(text)


def signed(x):
    return x - 2**64 if x >= 2**63 else x


@pytest.mark.parametrize("bucket", [64, 2])
def test_components_equal_brute_force(spark, monkeypatch, bucket):
    """Clusters, chains and shared halves, with pairs found in the table and with all hot values split."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rnd = random.Random(bucket)
    prints = {0}
    for _ in range(8):
        at = rnd.getrandbits(64)
        for _ in range(30):
            prints.add(at)
            for _ in range(rnd.choice([1, 2, 2, 3])):
                at ^= 1 << rnd.choice([rnd.randrange(64), rnd.randrange(8)])
    high = rnd.getrandbits(32) << 32
    prints |= {high | rnd.getrandbits(32) for _ in range(40)}
    rows = [(i, signed(p)) for i, p in enumerate(rnd.sample(sorted(prints), len(prints)))]
    rows += [(1000 + i, p) for i, (_, p) in enumerate(rows[:20])]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, fp bigint")).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows)
    assert len(got) == len(rows)


def test_hot_bucket_does_not_emit_all_pairs(spark):
    """All fingerprints share a half: links grow with the fingerprints, not with their pairs."""
    rows = [(x,) for x in range(3000)]
    links = simhash._links(spark.createDataFrame(rows, "fp bigint"))
    assert links.count() < 66 * 3000


def test_nulls_repeats_and_clashing_names(make_docs):
    rows = [(5, "a b c d e f"), (None, "a b c d e f"), (7, None), (3, ""), (3, ""), (None, None), (9, "other words of text here now")]
    docs = make_docs(rows).withColumns({"component_id": F.lit(1), "_hash": F.lit(2)})
    got = simhash.near_duplicates(simhash.add_fingerprints(docs.select("doc_id", "text"))).collect()
    parts = sorted((r.doc_id is None, r.doc_id or 0, r.fp == 0, r.component_id) for r in got)
    assert parts == [
        (False, 3, True, 3), (False, 3, True, 3), (False, 5, False, 5), (False, 7, True, 3), (False, 9, False, 9),
        (True, 0, False, 5), (True, 0, True, 3),
    ]
    named = simhash.add_fingerprints(docs.select("doc_id", "text")).withColumns({c: F.lit(9) for c in ("root", "first", "component_id", "node")})
    again = simhash.near_duplicates(named).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fp == 0, r.component_id) for r in again) == parts
    assert {(r.first, r.node) for r in again} == {(9, 9)}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.component_id, r._hash) for r in kept.collect()) == [(3, 1, 2), (5, 1, 2), (9, 1, 2)]


def test_group_of_null_ids_keeps_one(make_docs):
    assert simhash.keep_one(make_docs([(None, "a b c d"), (None, "a b c d"), (None, None)])).count() == 2


def test_empty(make_docs):
    docs = make_docs([])
    assert simhash.near_duplicates(simhash.add_fingerprints(docs.select("doc_id", "text"))).count() == 0
    assert simhash.keep_one(docs).count() == 0
