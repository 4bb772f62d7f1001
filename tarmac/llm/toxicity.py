"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A lexicon of words and word beginnings is drawn from labelled texts: those whose share of toxic texts stands out, by the
likelihood ratio against the share of all texts.  Features are densities of the lexicon, nearness of its hits to the second person,
capitals, punctuation and obfuscated spellings.  The trees are fitted on part of the labelled rows and calibrated on the rest,
so a score is the share of toxic texts to expect.

Lexicon and trees are fitted on at most ``MAX_LABELLED`` labelled ids (those with the smallest hashes), near copies once;
every text is scored, whole.  Labels of held-out ids are never read.

Defined cases: null and empty texts have features of zero and get a score like any other; without usable labels every
score is 0.  Repeated labels of one id count as toxic if one is; labels other than 0 and 1 are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from tarmac.llm.batches import small_batches
from tarmac.llm.names import numbered
from tarmac.session import cut_lineage

THRESHOLD = 0.3
MAX_LABELLED = 20_000
MAX_LEXICON = 2_000
LEAST_WEIGHT = 3.5  # signed root of the likelihood ratio
LEAST_SHARE = 0.2  # of the greatest weight
HELD_OUT_FOLD, CALIBRATION_FOLD = 2, 3
_NEAR = 5  # words between a hit and the second person
_CACHED = 200_000
_WORD = re.compile(r"[^\W_]+")
_OBFUSCATED = re.compile(r"[^\W\d_][0-9@$*|!]+[^\W\d_]")
#: Second person in the languages of the corpus (fixed values).
SECOND_PERSON = frozenset(
    """you your yours yourself du dich dir dein deine deinen euch ihr euer tu te toi ton ta tes vous votre vos
    tú ti tuyo usted ustedes vosotros vuestro""".split()
)
_MARKS = np.array([b in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" for b in range(256)])


def fold(key: Column) -> Column:
    return (F.crc32(key.cast("string").cast("binary")) % 4).cast("int")


def forms(word: str) -> tuple[str, ...]:
    """A word and its beginnings: the spellings that lexicon entries are compared with."""
    if len(word) <= 4:
        return (word,)
    return (word, word[:4] + "*") if len(word) == 5 else (word, word[:4] + "*", word[:5] + "*")


class Features:
    """Dense features of a text under a lexicon of weights by form."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        self._lexicon = lexicon
        self._weights: dict[str, float] = {}

    def _weight(self, word: str) -> float:
        weight = self._weights.get(word)
        if weight is None:
            weight = max((self._lexicon.get(form, 0.0) for form in forms(word)), default=0.0)
            self._weights[word] = weight
        return weight

    def of(self, text: str | None) -> list[float]:
        text = text or ""
        if len(self._weights) > _CACHED:
            self._weights.clear()
        words = _WORD.findall(text.lower())
        n = max(1, len(words))
        weights = list(map(self._weight, words))
        hits = [i for i, w in enumerate(weights) if w]
        near = 0
        for i in hits:
            near += any(w in SECOND_PERSON for w in words[max(0, i - _NEAR) : i + _NEAR + 1])
        total = sum(weights[i] for i in hits)
        counts = np.bincount(np.frombuffer(text.encode(), dtype=np.uint8), minlength=256)
        chars = max(1, int(counts.sum()))
        return [
            math.log1p(len(words)),
            len(hits) / n,
            math.log1p(len(hits)),
            float(len({words[i] for i in hits})),
            total / n,
            total,
            max((weights[i] for i in hits), default=0.0),
            near / max(1, len(hits)),
            sum(map(SECOND_PERSON.__contains__, words)) / n,
            counts[65:91].sum() / chars,
            counts[33] / chars,
            counts[63] / chars,
            counts[_MARKS].sum() / chars,
            counts[48:58].sum() / chars,
            len(_OBFUSCATED.findall(text)) / n,
        ]


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None

    def add_scores(self, docs: DataFrame, text: str = "text", score: str = "score") -> DataFrame:
        """``docs`` with ``score``, which replaces a column of that name."""
        docs = docs.drop(score) if score != text else docs
        if self.trees is None:
            return docs.withColumn(score, F.lit(0.0))
        plain, names = numbered(docs)
        margins = _add_margins(_add_features(plain, names[text], self.lexicon), self.trees)
        scored = self.calibration.transform(margins) if self.calibration else margins.withColumn("_tox_score", F.lit(0.0))
        value = F.round(F.least(F.greatest("_tox_score", F.lit(0.0)), F.lit(1.0)), 6)
        kept = [c for c in docs.columns if c != score]
        return scored.select(*[F.col(names[c]).alias(c) for c in kept], value.alias(score))


def _add_features(docs: DataFrame, text: str, lexicon: dict[str, float]) -> DataFrame:
    small_batches(docs.sparkSession)
    @F.arrow_udf("array<double>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        made = Features(lexicon)
        for texts in batches:
            yield pa.array([made.of(t.as_py()) for t in texts], pa.list_(pa.float64()))

    return docs.withColumn("_tox_features", array_to_vector(features(F.col(text))))


def _add_margins(docs: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    return trees.transform(docs).withColumn("_tox_margin", vector_to_array("_tox_raw")[1])


def _sample(docs: DataFrame, labels: DataFrame, text: str, key: str, limit: int) -> DataFrame:
    """At most ``limit`` labelled ids outside the held-out fold: ``text``, ``toxic``, ``fold``; equal texts once."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT_FOLD))
    one = usable.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("toxic"))
    chosen = one.orderBy(F.xxhash64("_id"), "_id").limit(limit)  # so its broadcast is bounded
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    joined = rows.join(F.broadcast(chosen), F.col("_key") == F.col("_id"))

    @F.arrow_udf("bigint")
    def sketch(texts: pa.Array) -> pa.Array:
        return pa.array([_sketch(t.as_py()) for t in texts], pa.int64())

    once = joined.groupBy(sketch("text").alias("sketch")).agg(
        F.min("text").alias("text"), F.max("toxic").cast("double").alias("toxic"), F.min(fold(F.col("_id"))).alias("fold")
    )
    return cut_lineage(once)


def _sketch(text: str) -> int:
    """Smallest hash of the runs of five words; near copies mostly share it."""
    words = _WORD.findall(text.lower())
    return min(xxhash.xxh64_intdigest(" ".join(words[i : i + 5])) for i in range(max(1, len(words) - 4))) >> 1


def _lexicon(sample: DataFrame) -> dict[str, float]:
    """Forms by weight: the root of the likelihood ratio of their share of toxic texts, where that is above the mean."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                seen = sorted({form for word in set(_WORD.findall(body.as_py().lower())) for form in forms(word)})
                ones = pa.array([toxic] * len(seen), pa.float64())  # a text without words has none, and an untyped empty array fails
                yield pa.RecordBatch.from_arrays([pa.array(seen, pa.string()), ones], names=["form", "toxic"])

    totals = sample.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    n_toxic, n_clean = (totals[0] or 0.0), (totals[1] or 0.0)
    counted = sample.select("text", "toxic").mapInArrow(count, "form string, toxic double").groupBy("form").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("c")
    )
    a, c, n = F.col("a"), F.col("c"), F.col("a") + F.col("c")
    mean = n_toxic / (n_toxic + n_clean)
    clean_part = F.when(c > 0, c * F.log(c / (n * max(1 - mean, 1e-9)))).otherwise(F.lit(0.0))
    weight = F.sqrt(F.greatest(2 * (a * F.log(a / (n * mean)) + clean_part), F.lit(0.0)))
    weighed = counted.where((a > 0) & (a > n * mean)).select("form", weight.alias("weight"))
    top = weighed.where(F.col("weight") >= LEAST_WEIGHT).orderBy(F.desc("weight"), "form").limit(MAX_LEXICON).collect()
    return {row.form: row.weight for row in top if row.weight >= LEAST_SHARE * top[0].weight}


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", limit: int = MAX_LABELLED
) -> ToxicityModel:
    small_batches(docs.sparkSession)
    sample = _sample(docs, labels, text, key, limit)
    if sample.where("toxic = 1").isEmpty():
        return ToxicityModel({}, None, None)
    lexicon = _lexicon(sample)
    rows = cut_lineage(_add_features(sample, "text", lexicon).select("_tox_features", "toxic", "fold").coalesce(4))
    learner = GBTClassifier(
        featuresCol="_tox_features", labelCol="toxic", predictionCol="_tox_class", maxIter=20, maxDepth=3, maxBins=64,
        stepSize=0.2, minInstancesPerNode=2, seed=7,
    ).setRawPredictionCol("_tox_raw").setProbabilityCol("_tox_p")
    held = rows.where(F.col("fold") == CALIBRATION_FOLD)
    fitted = rows.where(F.col("fold") != CALIBRATION_FOLD)
    # tables too small for two folds with a toxic text each use all rows for both
    if held.where("toxic = 1").isEmpty() or fitted.where("toxic = 1").isEmpty():
        held = fitted = rows
    trees = learner.fit(fitted)
    isotonic = IsotonicRegression(featuresCol="_tox_margin", labelCol="toxic", predictionCol="_tox_score")
    return ToxicityModel(lexicon, trees, isotonic.fit(_add_margins(held, trees)))


def add_scores(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """``docs`` with ``score`` of a model fitted on their own labelled rows."""
    return fit_toxicity(docs, labels, text, key, **options).add_scores(docs, text)


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``."""
    plain, names = numbered(docs)
    scored = add_scores(plain, labels, names["text"], names["doc_id"], **options)
    return scored.where(F.col("score") < threshold).drop("score").toDF(*docs.columns)
