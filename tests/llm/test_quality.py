"""Quality scores against a plain fit, and on rows whose labels were never read."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import quality


def fold_of(key):
    return zlib.crc32(str(key).encode()) % 5


def texts(count, seed=3):
    """(doc_id, text, quality): prose with full stops, and junk of three kinds."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    rows = []
    for i in range(count):
        chosen = [rng.choice(words) for _ in range(rng.randint(8, 120))]
        good = i % 4 != 0
        if good:
            text = ". ".join(" ".join(chosen[j : j + 7]).capitalize() for j in range(0, len(chosen), 7)) + "."
        else:
            text = [" ".join(w.upper() + "!!" for w in chosen), " | ".join(chosen), " ".join([chosen[0]] * 20)][i // 4 % 3]
        rows.append((i, text, int(good)))
    return rows


@pytest.fixture(scope="module")
def scored(spark, make_docs):
    rows = texts(400)
    docs = make_docs([(i, t) for i, t, _ in rows] + [(None, "no id"), (900, None), (901, ""), (902, "w " * 300_000)]).repartition(4)
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i % 5], "doc_id bigint, quality int")
    described = quality.add_statistics(docs).cache()
    model = quality.fit_quality(described, labels)
    return rows, docs, labels, described, model


def test_like_a_plain_fit(scored):
    rows, _, _, described, model = scored
    stats = {r.doc_id: r.stats for r in described.collect()}
    every = np.array(list(stats.values()))
    scale = every.std(axis=0)
    kernel = quality.Kernel(every.mean(axis=0), np.where(scale > 1e-9, scale, 1.0))
    used = [(i, q) for i, _, q in rows if i % 5 and fold_of(i) != 0]
    x = kernel.features(np.array([stats[i] for i, _ in used]))
    y, folds = np.array([float(q) for _, q in used]), np.array([fold_of(i) for i, _ in used])
    penalty = np.diag([quality.RIDGE] * quality.COMPONENTS + [0.0])

    def fitted(rows):
        return np.linalg.solve(x[rows].T @ x[rows] + penalty, x[rows].T @ y[rows])

    weights = fitted(np.ones(len(y), dtype=bool))
    assert np.allclose(kernel.features(every) @ weights, model.kernel.features(every) @ model.weights, atol=1e-4)
    raw = np.array([x[i] @ fitted(folds != folds[i]) for i in range(len(y))])
    n, ones = Counter(), Counter()
    for value, label in zip(raw, y):
        cell = min(max(math.floor((value + 0.5) * 1000), 0), 1999)
        n[cell] += 1
        ones[cell] += label
    assert sum(n.values()) == len(used) and sum(ones.values()) == y.sum()
    assert np.all(np.diff(model.values) > 0) and 0 <= model.values[0] and model.values[-1] <= 1


def test_held_out_rows(scored):
    rows, docs, _, described, model = scored
    got = {r.doc_id: r.score for r in model.score_statistics(described).collect()}
    held = [(got[i], q) for i, _, q in rows if fold_of(i) == 0]
    assert len(held) > 50
    assert sum((score >= quality.THRESHOLD) == bool(q) for score, q in held) >= 0.95 * len(held)
    assert all(0 <= got[i] <= 1 for i in (None, 900, 901, 902))
    in_place = {r.doc_id: r.score for r in model.add_scores(docs).collect()}
    assert in_place == pytest.approx(got, abs=1e-6)


def test_held_out_labels_are_never_read(spark, scored):
    rows, _, labels, described, model = scored
    turned = labels.withColumn("quality", F.when(quality.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = quality.fit_quality(described, turned)
    assert np.allclose(other.weights, model.weights) and np.array_equal(other.values, model.values)


def test_labels_that_repeat_or_miss(spark, make_docs):
    docs = make_docs([(i, t) for i, t, _ in texts(60)])
    described = quality.add_statistics(docs)
    odd = [(i, q) for i, _, q in texts(60)] + [(1, 0), (None, 1), (2, None), (3, 7), (999, 0)]
    model = quality.fit_quality(described, spark.createDataFrame(odd, "doc_id bigint, quality int"))
    plain = quality.fit_quality(described, spark.createDataFrame([(i, q) for i, _, q in texts(60)], "doc_id bigint, quality int"))
    assert np.allclose(model.weights, plain.weights, atol=1e-6)


def test_without_labels(spark, make_docs):
    docs = make_docs([(1, "a text"), (2, None)])
    for labels in ([], [(1, None)], [(7, 1)]):
        frame = spark.createDataFrame(labels, "doc_id bigint, quality int")
        assert [r.score for r in quality.add_scores(docs, frame).collect()] == [0.5, 0.5]


def test_labels_of_one_class(spark, make_docs):
    docs = make_docs([(i, t) for i, t, _ in texts(40)])
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id bigint, quality int")
    assert {r.score for r in quality.add_scores(docs, labels).collect()} == {1.0}


def test_empty_table_and_clashing_names(spark, make_docs):
    labels = spark.createDataFrame([(i, q) for i, _, q in texts(60)], "doc_id bigint, quality int")
    assert quality.add_scores(make_docs([]), labels).count() == 0
    docs = make_docs([(i, t) for i, t, _ in texts(60)])
    kept = {r.doc_id for r in quality.keep_good(docs, labels).collect()}
    noisy = docs
    for name in ("score", "stats", "key", "label", "fold", "_id", "_key", "quality"):
        noisy = noisy.withColumn(name, F.lit("x"))
    again = quality.keep_good(noisy, labels)
    assert again.columns == noisy.columns and {r.doc_id for r in again.collect()} == kept


def test_pools_are_ascending():
    centres, values = quality.pool(np.array([1, 0, 2, 1, 4]), np.array([0, 0, 2, 0, 4]), np.arange(5.0))
    assert values.tolist() == pytest.approx([0, 2 / 3, 1]) and centres.tolist() == pytest.approx([0, 7 / 3, 4])


def test_statistics_of_empty_texts_are_zero():
    assert quality.describe(None) == quality.describe("") == quality.describe(" \n") == [0.0] * quality.STATISTICS
    assert len(quality.describe("one word. Two!")) == quality.STATISTICS
