"""Sharding: groups stay whole, shards are near equal, slots have no gaps."""

import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tarmac.llm import sharding


def check(rows, got, shards):
    assert len(got) == len(rows)
    texts = defaultdict(set)
    slots = defaultdict(list)
    by_crc = defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        by_crc[r.text_crc32].add(r.shard)
        assert 0 <= r.shard < shards
    for shard in slots.values():
        assert sorted(shard) == list(range(len(shard)))
    for _, text in rows:
        texts[zlib.crc32((text or "").encode())].add(text or "")
    for crc, shards_of in by_crc.items():
        assert len(shards_of) <= len(texts[crc]) + 1  # null and empty texts have one checksum


@pytest.mark.parametrize("bundles", [16, 4096])
def test_shards_are_near_equal(make_docs, bundles):
    rnd = random.Random(bundles)
    rows = [(i, "".join(rnd.choice("abé ") for _ in range(rnd.randrange(1, 200)))) for i in range(1500)]
    rows += [(2000 + i, "copy of one text") for i in range(200)]
    got = sharding.shard_documents(make_docs(rows), 8, bundles=bundles).collect()
    check(rows, got, 8)
    loads = defaultdict(int)
    for r in got:
        loads[r.shard] += r.size
    assert sum(loads.values()) == sum(len(t.encode()) + 16 for _, t in rows)
    spread = max(loads.values()) - min(loads.values())
    assert spread <= (sum(loads.values()) // bundles if bundles > 100 else max(loads.values()) // 4)


def test_a_group_larger_than_a_shard_stays_whole(make_docs):
    rows = [(i, "the hot text") for i in range(500)] + [(1000 + i, f"other {i}") for i in range(300)]
    got = sharding.shard_documents(make_docs(rows), 8).collect()
    check(rows, got, 8)
    assert len({r.shard for r in got if r.doc_id < 1000}) == 1


def test_nulls_repeats_and_reruns(make_docs):
    rows = [(None, None), (1, None), (1, ""), (1, "a"), (1, "a"), (None, "a")]
    docs = make_docs(rows).withColumnRenamed("lang", "group")
    got = sharding.shard_documents(docs, 3).collect()
    check(rows, got, 3)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, sharding.shard_documents(docs, 3).collect()), key=str)
    assert len({r.shard for r in got if r.size == 17}) == 1


def test_empty(make_docs):
    assert sharding.shard_documents(make_docs([]), 4).count() == 0


def test_written_shards_hold_all_rows(spark, make_docs, tmp_path):
    docs = make_docs([(i % 20, f"text {i % 30}") for i in range(100)]).withColumns({"group": F.lit("clash"), "shard": F.lit("old")})
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back, docs = spark.read.parquet(str(tmp_path / "out")), docs.drop("shard")
    assert sorted(map(tuple, back.select(docs.columns).collect())) == sorted(map(tuple, docs.collect()))
    assert back.groupBy("text").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0


def test_schedule_is_longest_first():
    assert sharding.schedule([(1, 5), (2, 9), (3, 4), (4, 4)], 2) == {2: 0, 1: 1, 3: 1, 4: 0}
