"""Text quality by ridge regression on random Fourier features of document statistics, with isotonic calibration.

Every text is described by a few statistics: lengths, character classes, repetition of words, pairs and lines, entropy and
compressibility.  Standardised, they pass through cosines of random projections, whose inner products approximate a Gaussian
kernel.  The ridge fit needs only sums over rows (the normal equations), so every partition adds up its own rows and
the sums are added up by band of the matrix; all labelled rows take part, however many.

The sums are kept per fold of the ids.  What all folds but one add up to gives the fit for rows of that one, so each
labelled row gets a score from a fit that did not see it; these scores, counted on a fixed grid, are calibrated by pooling
adjacent violators.  The calibration is applied to the fit over all folds.  Labels of the held-out fold are never read.

The driver gets sums of fixed size: a matrix per fold and the grid.

Defined cases: null and empty texts have statistics of zero and are scored like any other; null ids are scored and never
learnt from; repeated labels of one id count as 1 if one is, labels other than 0 and 1 are ignored; without usable
labels every score is 0.5.
"""

from __future__ import annotations

import math
import operator
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tarmac.llm.batches import small_batches
from tarmac.llm.names import numbered
from tarmac.session import cut_lineage

THRESHOLD = 0.3
FOLDS, HELD_OUT_FOLD = 5, 0
COMPONENTS = 256
RIDGE = 0.1
SEED = 11
_BANDS = 16  # of the matrix, added up apart
_GRID = 2000  # cells of raw scores from -0.5 to 1.5
_REACH = 4.0  # standard deviations beyond which a statistic no longer counts
_SENTENCE = b".,;:?'\"()-"


def _bytes_in(members: bytes) -> np.ndarray:
    return np.isin(np.arange(256), np.frombuffer(members, dtype=np.uint8))


_UPPER = _bytes_in(bytes(range(65, 91)))
_LOWER = _bytes_in(bytes(range(97, 123)))
_DIGIT = _bytes_in(b"0123456789")
_BLANK = _bytes_in(b"\t\n\x0b\x0c\r ")
_MILD = _bytes_in(_SENTENCE)
_SYMBOL = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)]) & ~_MILD
_CONTROL = (np.arange(256) < 32) & ~_BLANK
_WIDE = np.arange(256) > 127

STATISTICS = 21


def describe(text: str | None) -> list[float]:
    """Statistics of a whole text."""
    text = text or ""
    data, words = text.encode(), text.split()
    if not words:
        return [0.0] * STATISTICS
    n, size = len(words), len(data)
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=n)
    seen = Counter(words)
    pairs = len(set(zip(words, words[1:]))) if n > 1 else 1
    lines = [line for line in text.split("\n") if line.strip()]
    share = counts[counts > 0] / size
    letters = max(1, int(counts[_UPPER | _LOWER].sum()))
    return [
        math.log1p(n),
        float(lengths.mean()),
        float(lengths.std()),
        float(lengths.max() ** 0.5),
        counts[_UPPER].sum() / letters,
        counts[_MILD].sum() / size,
        math.sqrt(counts[_SYMBOL].sum() / size),
        math.sqrt(counts[124] / size),
        math.sqrt(counts[33] / size),
        math.sqrt(counts[_DIGIT].sum() / size),
        counts[_BLANK].sum() / size,
        counts[_CONTROL].sum() / size,
        counts[_WIDE].sum() / size,
        float(-(share * np.log2(share)).sum()),
        len(seen) / n,
        max(seen.values()) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        1 - pairs / max(1, n - 1),
        1 - len(set(lines)) / len(lines),
        math.log1p(n / len(lines)),
        len(zlib.compress(data, 1)) / (size + 16),
    ]


def fold(key: Column) -> Column:
    return (F.crc32(key.cast("string").cast("binary")) % FOLDS).cast("int")


def add_statistics(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and ``stats`` of every row; the texts stay behind."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = pa.array([describe(t.as_py()) for t in batch.column("text")], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), stats], names=["key", "stats"])

    schema = rows.selectExpr("key", "array(0D) AS stats").schema
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def _matrix(stats: pa.Array) -> np.ndarray:
    return stats.flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS)


@dataclass
class Kernel:
    """Random Fourier features of standardised statistics: cosines whose inner products approximate a Gaussian kernel."""

    mean: np.ndarray
    scale: np.ndarray
    components: int = COMPONENTS
    seed: int = SEED

    def __post_init__(self) -> None:
        rng = np.random.default_rng(self.seed)
        self.directions = rng.standard_normal((STATISTICS, self.components)) / math.sqrt(STATISTICS)
        self.phases = rng.uniform(0, 2 * math.pi, self.components)

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Cosines, and a constant column at the end."""
        plain = np.clip((stats - self.mean) / self.scale, -_REACH, _REACH)
        waves = np.cos(plain @ self.directions + self.phases) * math.sqrt(2 / self.components)
        return np.hstack((waves, np.ones((len(stats), 1))))


def solve(sums: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge weights from the products of features and, in the last row and column, the label."""
    penalty = np.eye(len(sums) - 1) * ridge
    penalty[-1, -1] = 1e-9  # the constant is free
    return np.linalg.solve(sums[:-1, :-1] + penalty, sums[:-1, -1])


def pool(n: np.ndarray, ones: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling adjacent violators: centre and mean of each pool, both ascending."""
    pools: list[list[float]] = []
    for count, hits, centre in zip(n, ones, centres):
        if count:
            pools.append([count, hits, count * centre])
            while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[2] / p[0] for p in pools]), np.array([p[1] / p[0] for p in pools])


def _cell(raw: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((raw + 0.5) * (_GRID / 2)), 0, _GRID - 1).astype(np.int64)


@dataclass
class QualityModel:
    kernel: Kernel | None
    weights: np.ndarray | None
    knots: np.ndarray | None
    values: np.ndarray | None

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.kernel is None:
            return np.full(len(stats), 0.5)
        return np.round(np.interp(self.kernel.features(stats) @ self.weights, self.knots, self.values), 6)

    def score_statistics(self, described: DataFrame, score: str = "score") -> DataFrame:
        """Rows of ``add_statistics`` with ``score`` in place of ``stats``."""

        @F.arrow_udf("double")
        def scored(stats: pa.Array) -> pa.Array:
            return pa.array(self.score(_matrix(stats)), pa.float64())

        return described.withColumn(score, scored("stats")).drop("stats")

    def add_scores(self, docs: DataFrame, text: str = "text", score: str = "score") -> DataFrame:
        """``docs`` with ``score``, which replaces a column of that name."""
        small_batches(docs.sparkSession)

        @F.arrow_udf("double")
        def scored(texts: pa.Array) -> pa.Array:
            stats = np.array([describe(t.as_py()) for t in texts]).reshape(-1, STATISTICS)
            return pa.array(self.score(stats), pa.float64())

        return docs.withColumn(score, scored(F.col(text)))


def _summed(rows: DataFrame, kernel: Kernel) -> dict[int, np.ndarray]:
    """Per fold, the products of features and label summed over its rows."""
    width = kernel.components + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.float64)
            own = batch.column("fold").to_numpy(zero_copy_only=False)
            wide = np.hstack((kernel.features(_matrix(batch.column("stats"))), label[:, None]))
            for number in np.unique(own).tolist():
                part = wide[own == number]
                sums[number] = sums.get(number, 0.0) + part.T @ part
        for number, total in sums.items():
            bands = np.array_split(total, _BANDS)
            values = pa.array([band.ravel() for band in bands], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * _BANDS, pa.int32()), pa.array(range(_BANDS), pa.int32()), values], names=["fold", "band", "sums"]
            )

    def add(key: tuple, parts: pa.Table) -> pa.Table:
        total = np.sum([p.values.to_numpy() for p in parts.column("sums")], axis=0)
        return pa.table({"fold": [key[0]], "band": [key[1]], "sums": [total]}, schema=wanted)

    wanted = pa.schema([("fold", pa.int32()), ("band", pa.int32()), ("sums", pa.list_(pa.float64()))])
    schema = "fold int, band int, sums array<double>"
    bands = rows.mapInArrow(run, schema).groupBy("fold", "band").applyInArrow(add, schema).collect()
    found: dict[int, list] = {}
    for row in sorted(bands):
        found.setdefault(row.fold, []).append(np.array(row.sums))
    return {number: np.concatenate(parts).reshape(width, width) for number, parts in found.items()}


def _counted(rows: DataFrame, raw_of: Callable[[pa.RecordBatch], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows and labels of 1 per cell of the grid of raw scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, ones = np.zeros(_GRID, dtype=np.int64), np.zeros(_GRID, dtype=np.int64)
        for batch in batches:
            cells = _cell(raw_of(batch))
            n += np.bincount(cells, minlength=_GRID)
            ones += np.bincount(cells[batch.column("label").to_numpy(zero_copy_only=False) == 1], minlength=_GRID)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in (used, n[used], ones[used])], names=["cell", "n", "ones"])

    n, ones = np.zeros(_GRID, dtype=np.int64), np.zeros(_GRID, dtype=np.int64)
    counted = rows.mapInArrow(run, "cell bigint, n bigint, ones bigint").groupBy("cell").agg(F.sum("n"), F.sum("ones"))
    for cell, count, hits in counted.collect():
        n[cell], ones[cell] = count, hits
    return n, ones


def fit_quality(
    described: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", components: int = COMPONENTS, ridge: float = RIDGE
) -> QualityModel:
    """Fit on the labelled rows among ``described`` (from ``add_statistics``) outside the held-out fold.

    ``labels`` has ``doc_id`` and ``label``.
    """
    at = F.col("doc_id")
    usable = labels.where(F.col(label).isin(0, 1) & at.isNotNull() & (fold(at) != HELD_OUT_FOLD))
    one = usable.groupBy(at.alias("_id")).agg(F.max(label).cast("int").alias("label"))
    rows = cut_lineage(
        described.select(F.col(key).alias("_key"), "stats").join(one, F.col("_key") == F.col("_id"))
        .select("stats", "label", fold(F.col("_id")).alias("fold"))
    )
    moments = described.agg(
        *[f(F.col("stats")[i]) for f in (F.avg, F.stddev_pop) for i in range(STATISTICS)], F.count("*")
    ).first()
    mean = np.array([v or 0.0 for v in moments[:STATISTICS]])
    scale = np.array([v if v and v > 1e-9 else 1.0 for v in moments[STATISTICS : 2 * STATISTICS]])
    kernel = Kernel(mean, scale, components)
    sums = _summed(rows, kernel)
    if not sums:
        return QualityModel(None, None, None, None)
    total = np.sum(list(sums.values()), axis=0)
    apart = {number: solve(total - own, ridge) for number, own in sums.items()}

    def raw(batch: pa.RecordBatch) -> np.ndarray:
        features, own = kernel.features(_matrix(batch.column("stats"))), batch.column("fold").to_numpy(zero_copy_only=False)
        scores = np.zeros(len(features))
        for number in np.unique(own).tolist():
            scores[own == number] = features[own == number] @ apart[number]
        return scores

    n, ones = _counted(rows, raw)
    knots, values = pool(n, ones, (np.arange(_GRID) + 0.5) * (2 / _GRID) - 0.5)
    return QualityModel(kernel, solve(total, ridge), knots, values)


def add_scores(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """``docs`` with ``score`` of a model fitted on their own labelled rows."""
    described = cut_lineage(add_statistics(docs, text, key))
    return fit_quality(described, labels, key, **options).add_scores(docs, text)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """Rows of ``docs`` that score ``threshold`` or more."""
    plain, names = numbered(docs)
    scored = add_scores(plain, labels, names["text"], names["doc_id"], **options)
    return scored.where(F.col("score") >= threshold).drop("score").toDF(*docs.columns)
