"""Document fingerprints by winnowing.

Rolling hashes of all grams of ``GRAM`` code points; from every window of ``WINDOW`` grams the smallest hash is chosen, the
rightmost of equals, and kept with its position.  Any passage of ``WINDOW + GRAM - 1`` code points that two texts
share therefore puts an equal hash into both fingerprints.

Defined cases: a text shorter than a gram is one gram; one with fewer grams than a window is one window; an empty or null
text has an empty fingerprint, and two empty fingerprints are alike (1.0).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tarmac.llm.batches import small_batches

GRAM = 16
WINDOW = 24
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_LAST = np.uint64(0xFFFFFFFF)
_HIGH = np.uint64(32)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def gram_hashes(text: str, gram: int = GRAM) -> np.ndarray:
    """32-bit hashes of all grams, rolled: each is a difference of prefix sums, shifted to a common power."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    n = len(codes)
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    gram = min(gram, n)
    sums = np.cumsum(codes * _powers(_INVERSE, n), dtype=np.uint64)
    sums[gram:] -= sums[: n - gram].copy()
    rolled = sums[gram - 1 :] * _powers(_BASE, n - gram + 1)
    rolled ^= rolled >> _HIGH
    rolled *= _MIX
    return rolled >> _HIGH


def winnow(text: str | None, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions chosen, in order of position."""
    hashes = gram_hashes(text or "", gram)
    n = len(hashes)
    if n == 0:
        return hashes, hashes
    window = min(window, n)
    # the smallest key of a window has the smallest hash and, of equals, the greatest position
    least = (hashes << _HIGH) | (_LAST - np.arange(n, dtype=np.uint64))
    span = 1
    while span * 2 <= window:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < window:
        least = np.minimum(least[: span - window], least[window - span :])
    chosen = least[np.concatenate(([True], least[1:] != least[:-1]))]
    return chosen >> _HIGH, _LAST - (chosen & _LAST)


def as_string(hashes: np.ndarray, positions: np.ndarray) -> str:
    """``hash@position`` (eight hex digits, decimal) of each choice, comma-joined."""
    return ",".join([f"{h:08x}@{p}" for h, p in zip(hashes.tolist(), positions.tolist())])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared part of two sets of distinct hashes, 0 to 1."""
    if len(a) == 0 and len(b) == 0:
        return 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def add_fingerprints(docs: DataFrame, text: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``docs`` with arrays ``hashes`` and ``positions``, which replace columns of that name."""
    kept = [c for c in docs.columns if c not in ("hashes", "positions")]
    added = [F.array(F.lit(0).cast("bigint")).alias(c) for c in ("hashes", "positions")]
    schema = docs.select(*kept, *added).schema
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [winnow(t.as_py(), gram, window) for t in batch.column(text)]
            arrays = [pa.array([pair[i].astype(np.int64) for pair in found], pa.list_(pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *arrays], names=[*kept, "hashes", "positions"])

    return docs.mapInArrow(run, schema)


RUN_ROWS = 1024
MAX_RUNS = 10_000


def in_runs(docs: DataFrame, text: str, key: str) -> DataFrame:
    """``docs`` sorted by ``key`` (null last) and text hash in runs of consecutive keys, each followed by its successor.

    A run also gets the first rows of the next run (the last run those of the first) with ``ahead`` set.  Cuts between
    runs are keys of the table, at most MAX_RUNS, found by one pass over the keys.  Texts move once.
    """
    keys = docs.select(key)
    runs = min(MAX_RUNS, max(1, keys.count() // RUN_ROWS))
    shares = F.expr(f"array({', '.join(f'{i / (runs + 1)}D' for i in range(1, runs + 1))})")
    bounds = keys.agg(
        F.min(key).alias("least"),
        F.percentile_approx(key, shares, max(10_000, 20 * runs)).alias("cuts"),
        F.coalesce(F.max(F.col(key).isNull()), F.lit(False)).alias("nulls"),
    ).first()
    cuts = np.array(sorted({bounds.least, *(bounds.cuts or [])} - {None}), dtype=np.int64)
    last = len(cuts) - (0 if bounds.nulls else 1)  # null keys are a run of their own

    @F.arrow_udf("int")
    def place(keys: pa.Array) -> pa.Array:
        """Twice the number of the run, and one more for a row that starts it."""
        missing, values = keys.is_null().to_numpy(zero_copy_only=False), keys.fill_null(0).to_numpy()
        run = np.where(missing, last, np.searchsorted(cuts, values, side="right") - 1)
        starts = missing | np.isin(values, cuts)
        return pa.array((run * 2 + starts).astype(np.int32))

    number, is_start = F.floor(F.col("_place") / 2).cast("int"), F.col("_place") % 2 == 1
    before = F.when(number == 0, F.lit(last)).otherwise(number - 1)
    own = F.struct(number.alias("run"), F.lit(False).alias("ahead"))
    lead = F.struct(before.alias("run"), F.lit(True).alias("ahead"))
    return (
        docs.withColumn("_place", place(key))
        .withColumn("_at", F.explode(F.when(is_start, F.array(own, lead)).otherwise(F.array(own))))
        .select(*docs.columns, "_at.run", "_at.ahead")
        .repartition("run")
        .sortWithinPartitions("run", "ahead", F.col(key).asc_nulls_last(), F.xxhash64(text))
    )


def compare_with_next(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like the text's is to the edited and the next one's.

    The edited text has its last quarter replaced by as many code points from the start of the next document, in
    order of ``key``.  Rows that share a key follow each other by text hash; null keys come last.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    small_batches(docs.sparkSession)
    schema = (
        "key bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def read(body: str):
        hashes, positions = winnow(body)
        return body, hashes, positions, np.unique(hashes)

    def judge(row_key, own, following) -> tuple:
        body, hashes, positions, distinct = own
        tail = len(body) // 4
        _, edited_hashes, edited_positions, edited = (changed := read(body[: len(body) - tail] + following[0][:tail]))
        return (
            row_key,
            len(body),
            hashlib.sha256(changed[0].encode()).hexdigest(),
            as_string(hashes, positions),
            as_string(edited_hashes, edited_positions),
            likeness(distinct, edited),
            likeness(distinct, following[3]),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting, done = None, None, None  # the run, its last row without successor, and whether it is finished
        for batch in batches:
            out = []
            for row_key, body, number, ahead in zip(*(batch.column(c) for c in ("key", "text", "run", "ahead"))):
                number, ahead = number.as_py(), ahead.as_py()
                if number != at:
                    at, waiting, done = number, None, False
                if done:
                    continue
                here = (row_key.as_py(), read(body.as_py()))
                if waiting is not None:
                    out.append(judge(*waiting, here[1]))
                waiting, done = here, ahead
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=names)

    return in_runs(rows, "text", "key").mapInArrow(run, schema).withColumnRenamed("key", key)


_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
