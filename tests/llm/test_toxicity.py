"""Toxicity: held-out accuracy, independence of labels it must not read, and odd inputs."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from tarmac.llm import toxicity

RUDE = ["moron", "scumbag", "idiot", "loser"]


def corpus(n, seed=1):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        toxic = rnd.random() < 0.25
        text = [rnd.choice(words) for _ in range(rnd.randrange(15, 60))]
        if toxic:
            for _ in range(3):
                text.insert(rnd.randrange(len(text)), rnd.choice(RUDE))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


def held_out(key):
    return zlib.crc32(str(key).encode()) % 4 == 2


def scores(spark, docs, labels):
    given = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    return {r.doc_id: r.score for r in toxicity.add_scores(docs, given).collect()}


def test_held_out_accuracy_and_unread_labels(spark, make_docs):
    rows, labels = corpus(900)
    got = scores(spark, make_docs(rows), labels)
    judged = [(got[i] >= toxicity.THRESHOLD) == bool(y) for i, y in labels if held_out(i)]
    assert len(judged) > 150 and sum(judged) / len(judged) > 0.95
    assert all(0 <= s <= 1 for s in got.values())
    turned = [(i, 1 - y if held_out(i) else y) for i, y in labels]
    assert scores(spark, make_docs(rows), turned) == got


def test_filter_keeps_rows_and_clashing_columns(spark, make_docs):
    rows, labels = corpus(400, 2)
    rows += [(None, None), (None, ""), (3, "plain words"), (3, "plain words"), (7001, "x" * 200_000)]
    docs = make_docs(rows).withColumns({"score": F.lit("clash"), "_tox_raw": F.lit(1), "fold": F.lit(2)})
    given = spark.createDataFrame(labels + [(None, 1), (3, None), (4, 7)], "doc_id bigint, toxic int")
    kept = toxicity.keep_clean(docs, given)
    assert kept.columns == docs.columns
    out = kept.collect()
    toxic = {i for i, y in labels if y and i not in (3, 4)}
    assert {r.score for r in out} == {"clash"}
    assert sum(r.text is None for r in out) == 1 and sum(r.text == "plain words" for r in out) == 2
    assert len([r for r in out if r.doc_id in toxic]) < 0.1 * len(toxic)
    assert len(out) > 0.95 * (len(rows) - len(toxic))


@pytest.mark.parametrize("wordless", [None, "", "!?* _"])
def test_labelled_texts_without_words_take_part_in_the_fit(spark, make_docs, wordless):
    rows, labels = corpus(300, 3)
    clean = next(i for i, y in labels if not y and not held_out(i))
    docs = make_docs([(i, wordless if i == clean else text) for i, text in rows])
    got = scores(spark, docs, labels)
    assert len(got) == len(rows) and got[clean] < toxicity.THRESHOLD
    judged = [(got[i] >= toxicity.THRESHOLD) == bool(y) for i, y in labels]
    assert sum(judged) / len(judged) > 0.95


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(2, 0), (3, 0), (5, 0)]])
def test_without_toxic_labels_all_scores_are_zero(spark, make_docs, labels):
    got = scores(spark, make_docs([(1, "a"), (2, None), (3, "")]), labels)
    assert set(got.values()) == {0.0} and len(got) == 3


def test_empty_documents(spark, make_docs):
    assert scores(spark, make_docs([]), [(1, 1)]) == {}


def test_features_read_whole_texts():
    made = toxicity.Features({"moro*": 5.0})
    plain, late = made.of("word " * 30_000), made.of("word " * 30_000 + "you MORON!")
    assert plain[2] == 0 and late[2] > 0 and late[6] == 5.0 and late[7] == 1.0
    assert made.of(None) == made.of("")
