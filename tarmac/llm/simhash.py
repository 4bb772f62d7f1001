"""SimHash near-duplicates by multi-index hashing.

A fingerprint of 64 bits has two segments of 32.  Two fingerprints at most 2 bits apart differ by at most 1 bit in one of
them.  So each fingerprint looks up, per segment, the small ball around its value (itself and each value with one
more bit set; the other direction is found from the other side) in the table of all fingerprints by segment value,
and the whole distance of every match is verified.

A segment value that more than ``BUCKET`` different fingerprints share is not matched pair by pair.  There, the ball is
enumerated over the other segment too: fingerprints meet at a full value at most 1 bit away from each of them.  Any two that
meet are at most 2 bits apart, and any two of the bucket at most 2 bits apart do meet, so linking each to the smallest
that met there is exact.  At most 65 fingerprints can meet at one value.

Defined cases: a text without words (null, empty, blank) has fingerprint zero, which links like any other; ids may
repeat or be null (a component of null ids only has a null id).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tarmac.llm.batches import small_batches
from tarmac.llm.components import components
from tarmac.llm.names import numbered
from tarmac.session import cut_lineage

MAX_BITS = 2
BUCKET = 64
_BLOCK = 1 << 16  # shingles whose bits are counted at once
_HALF = "4294967295L"


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """Signed 64-bit SimHash over the word shingles of a text, repeats included."""
    # bytes.lower changes A-Z only; bytes.split cuts at \x20 and \x09-\x0D
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    starts, ends, at = [], [], 0
    for token in tokens:
        starts.append(at)
        at += len(token)
        ends.append(at)
        at += 1
    ends = ends[min(words, len(tokens)) - 1 :]
    counts = np.zeros(64, dtype=np.int64)
    for low in range(0, len(ends), _BLOCK):
        hashes = np.array(
            [xxhash.xxh64_intdigest(joined[s:e], seed) for s, e in zip(starts[low : low + _BLOCK], ends[low : low + _BLOCK])],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(ends), bitorder="little").view("<i8")[0])


def add_fingerprints(docs: DataFrame, text: str = "text", words: int = 3) -> DataFrame:
    """``docs`` without ``text``, with ``fp`` (bigint)."""
    kept = [c for c in docs.columns if c != text]
    schema = docs.select(*kept, F.lit(0).cast("bigint").alias("fp")).schema
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array([fingerprint(t.as_py(), words) for t in batch.column(text)], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), values], names=[*kept, "fp"])

    return docs.mapInArrow(run, schema)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _links(prints: DataFrame) -> DataFrame:
    """Edges ``u, v`` that connect exactly the fingerprints (distinct ``fp``) at most MAX_BITS apart."""
    low, high = F.expr(f"fp & {_HALF}"), F.expr("shiftrightunsigned(fp, 32)")
    halves = F.array(
        F.struct(F.lit(0).alias("segment"), low.alias("key")), F.struct(F.lit(1).alias("segment"), high.alias("key"))
    )
    entries = prints.select("fp", F.inline(halves))
    hot = cut_lineage(entries.groupBy("segment", "key").count().where(F.col("count") > BUCKET).drop("count"))
    table = (
        entries.join(hot, ["segment", "key"], "left_anti")
        .withColumnRenamed("fp", "other")
        .unionByName(hot.withColumn("other", F.lit(None).cast("bigint")))  # one mark per hot value
    )
    ball = F.expr(
        "concat(array(key), transform(filter(sequence(0, 31), b -> bit_get(key, b) = 0), b -> key + shiftleft(1L, b)))"
    )
    probes = entries.withColumn("own", F.col("key")).withColumn("key", F.explode(ball))
    near = F.expr(f"other IS NULL OR (bit_count(fp ^ other) BETWEEN 1 AND {MAX_BITS} AND (key <> own OR fp < other))")
    found = cut_lineage(
        probes.join(table, ["segment", "key"]).where(near).select("segment", "key", "own", "fp", "other")
    )
    pairs = found.where("other IS NOT NULL").select(F.col("fp").alias("u"), F.col("other").alias("v"))

    meeting = F.expr(
        f"""CASE WHEN key = own
              THEN concat(array(fp), transform(sequence(0, 31), b -> fp ^ shiftleft(1L, b + IF(segment = 0, 32, 0))))
              ELSE array(IF(segment = 0, (fp & ~{_HALF}) | key, (fp & {_HALF}) | shiftleft(key, 32))) END"""
    )
    met = found.where("other IS NULL").select("fp", F.explode(meeting).alias("at")).distinct()
    least = F.min("fp").over(Window.partitionBy("at"))  # at most 65 rows each
    stars = met.select(F.col("fp").alias("u"), least.alias("v"))
    return pairs.unionByName(stars).where("u <> v")


def near_duplicates(prints: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``prints`` (``key``, ``fp``, other columns) with ``component_id``, the smallest ``key`` reachable.

    ``root``, a fingerprint of the component, names it even where all keys are null.  Columns of ``prints`` with these
    names are replaced.
    """
    prints = cut_lineage(prints.drop("root", "component_id"))
    firsts = cut_lineage(prints.groupBy("fp").agg(F.min(key).alias("first")))
    parts = cut_lineage(components(_links(firsts.select("fp"))).withColumnRenamed("node", "fp"))
    of_root = parts.join(firsts, "fp").groupBy("root").agg(F.min("first").alias("component_id"))
    linked = parts.join(of_root, "root")
    alone = firsts.join(parts, "fp", "left_anti").select("fp", F.col("fp").alias("root"), F.col("first").alias("component_id"))
    return prints.join(linked.select("fp", "root", "component_id").unionByName(alone), "fp")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the smallest ``key`` (null last)."""
    plain, names = numbered(docs)
    own = plain.withColumns({"key": F.col(names[key]), "hash": F.xxhash64(*plain.columns)})
    rows = own.select("key", "hash", F.col(names[text]).alias("text"))
    grouped = near_duplicates(add_fingerprints(rows, "text", words), "key")
    first = F.struct(F.col("key").isNull().alias("none"), F.col("key").alias("k"), F.col("hash").alias("h"))
    kept = grouped.groupBy("root").agg(F.min(first).alias("first")).select("first.k", "first.h")
    joined = own.join(kept, (F.col("hash") == F.col("h")) & F.col("key").eqNullSafe(F.col("k")))
    nth = F.row_number().over(Window.partitionBy("hash", "key").orderBy("hash", "key"))  # of rows equal in all columns
    return joined.withColumn("nth", nth).where("nth = 1").select(*plain.columns).toDF(*docs.columns)
