"""Ranked lexical search of a stated set of items by scanning the documents.

The distinct terms of a block of items make one Aho-Corasick automaton, whose patterns carry a boundary on both sides.  Texts
get the same boundaries by one byte table, so a match is a whole term, and one pass over a text counts the occurrences of
every term of every item; no index of the documents is made.  The outputs of the automaton are term numbers, which
map to the items that hold the term.

There are two scans per block of items: the first adds up in how many documents each term occurs, and the
number of documents and terms; the second scores each document for all items and keeps the best of each item per task.  These
few meet in a rank per item.  Documents are never shuffled.

Only a block is broadcast: the terms of at most ``BLOCK_ITEMS`` items.  More items take more scans.

Terms are runs of ASCII letters and digits and of all code points beyond ASCII; only A-Z is lowered.

Defined cases: a null or empty text has no terms and is never found; an item without terms finds nothing; each row of the
items is an item, also with a null or repeated id; repeated documents are documents of their own; of equal scores the smaller
document id comes first, null last; scores are exact integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from tarmac.llm.batches import small_batches
from tarmac.operators.keys import dense_ids
from tarmac.session import cut_lineage

BLOCK_ITEMS = 256
_PAIRS = 1 << 20  # term occurrences by items that are added up at once
_LOW_BITS = 20
#: Letters are lowered, digits and bytes beyond ASCII stay, everything else is a boundary.
_TABLE = bytes(b if b > 127 or chr(b).isdigit() else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


def bounded(text: bytes) -> bytes:
    """The text with a space at every boundary, and one at both ends."""
    return b" " + text.translate(_TABLE) + b" "


def count_terms(text: bytes) -> int:
    """Number of terms in a bounded text, repeats included."""
    inside = np.frombuffer(text, dtype=np.uint8) != 32
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]))


@dataclass
class ItemBlock:
    """Distinct terms of a block of items and, per term, the items that hold it and how often."""

    terms: list[bytes]
    starts: np.ndarray  # of a term's entries in the two lists below
    items: np.ndarray
    times: np.ndarray
    numbers: np.ndarray  # of the items, in the whole set

    @classmethod
    def of(cls, rows: list[tuple[int, str | None]]) -> ItemBlock:
        holders: dict[bytes, list[tuple[int, int]]] = {}
        for i, (_, text) in enumerate(rows):
            for term, times in Counter(bounded((text or "").encode()).split()).items():
                holders.setdefault(term, []).append((i, times))
        flat = list(chain.from_iterable(holders.values()))
        return cls(
            list(holders),
            np.cumsum([0, *map(len, holders.values())]),
            np.array([i for i, _ in flat], dtype=np.int64),
            np.array([n for _, n in flat], dtype=np.int64),
            np.array([number for number, _ in rows], dtype=np.int64),
        )

    def automaton(self) -> ahocorasick.Automaton:
        """One code point per byte; the value of a pattern is its term's number."""
        made = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            made.add_word(f" {term.decode('latin-1')} ", number)
        made.make_automaton()
        return made


class Scanner:
    """Occurrences of a block's terms in texts."""

    def __init__(self, block: ItemBlock) -> None:
        self._automaton = block.automaton() if block.terms else None

    def hits(self, text: bytes) -> Iterator[int]:
        """A term number per occurrence in a bounded text."""
        if self._automaton is None:
            return iter(())
        return map(itemgetter(1), self._automaton.iter(text.decode("latin-1")))


class Best:
    """The ``k`` best documents per item among those seen."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.least = k, np.ones(items, dtype=np.int64)  # a score from which a document may enter
        self.item, self.score, self.doc = (np.empty(0, dtype=np.int64) for _ in range(3))
        self.missing = np.empty(0, dtype=bool)  # ids that are null

    def add(self, scores: np.ndarray, docs: np.ndarray, missing: np.ndarray) -> None:
        """Scores by document and item."""
        row, item = np.nonzero(scores >= self.least)
        if not len(row):
            return
        item = np.concatenate((self.item, item))
        score = np.concatenate((self.score, scores[row, item[len(self.item) :]]))
        doc, none = np.concatenate((self.doc, docs[row])), np.concatenate((self.missing, missing[row]))
        order = np.lexsort((doc, none, -score, item))
        item = item[order]
        first = np.searchsorted(item, item)  # where an item's documents begin
        nth = np.arange(len(item)) - first
        kept = order[nth < self.k]
        self.item, self.score, self.doc, self.missing = item[nth < self.k], score[kept], doc[kept], none[kept]
        last = nth == self.k - 1
        self.least[item[last]] = score[order[last]]


def _statistics(docs: DataFrame, block: Broadcast) -> tuple[int, int, np.ndarray]:
    """Documents with a term, their terms with repeats, and the documents that hold each term of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, found = Scanner(block.value), np.zeros(len(block.value.terms) + 2, dtype=np.int64)
        for batch in batches:
            for text in _texts(batch):
                terms = count_terms(text)
                found[-2] += terms > 0
                found[-1] += terms
                holds = set(scanner.hits(text))
                found[np.fromiter(holds, dtype=np.int64, count=len(holds))] += 1
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(found[used])], names=["term", "n"])

    terms = len(block.value.terms)
    summed = docs.mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(terms + 2, dtype=np.int64)
    for term, n in summed:
        found[term] = n
    return int(found[-2]), int(found[-1]), found[:-2]


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for text in batch.column("text").cast(pa.binary()):
        yield bounded(text.as_py() or b"")


def weights(documents: int, holding: np.ndarray) -> np.ndarray:
    """Weight of each term by the number of documents that hold it."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in holding.tolist()], dtype=np.int64)


def _scored(docs: DataFrame, block: Broadcast, documents: int, terms: int, weight: np.ndarray, k: int) -> DataFrame:
    """``item, doc, score``: the best documents of each item in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = block.value
        scanner, n_items = Scanner(own), len(own.numbers)
        best = Best(n_items, k)
        spread = np.diff(own.starts)

        def score(rows: list[tuple[int, Counter]], ids: pa.Array) -> None:
            """Scores of some documents for all items at once."""
            row = np.repeat(np.arange(len(rows)), [len(found) for _, found in rows])
            term = np.fromiter(chain.from_iterable(found for _, found in rows), dtype=np.int64, count=len(row))
            tf = np.fromiter(chain.from_iterable(found.values() for _, found in rows), dtype=np.int64, count=len(row))
            m = np.array([100 - 75 + (75 * n * documents) // terms for n, _ in rows], dtype=np.int64)
            part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
            entries = spread[term]
            begin = np.cumsum(entries) - entries
            entry = np.arange(entries.sum()) + np.repeat(own.starts[term] - begin, entries)
            cell = np.repeat(row, entries) * n_items + own.items[entry]
            part = np.repeat(part, entries) * own.times[entry]
            # sums of doubles are exact below 2^53, so both halves of the numbers are added up on their own
            high = np.bincount(cell, part >> _LOW_BITS, len(rows) * n_items).astype(np.int64)
            low = np.bincount(cell, part & ((1 << _LOW_BITS) - 1), len(rows) * n_items).astype(np.int64)
            docs = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            best.add(((high << _LOW_BITS) + low).reshape(len(rows), n_items), docs, missing)

        for batch in batches:
            rows, at, pairs = [], [], 0
            ids = batch.column("doc")
            for i, text in enumerate(_texts(batch)):
                found = Counter(scanner.hits(text))
                if not found:
                    continue
                rows.append((count_terms(text), found))
                at.append(i)
                pairs += int(spread[list(found)].sum())
                if pairs > _PAIRS:
                    score(rows, ids.take(pa.array(at)))
                    rows, at, pairs = [], [], 0
            if rows:
                score(rows, ids.take(pa.array(at)))
        doc = pa.array(best.doc, pa.int64(), mask=best.missing)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own.numbers[best.item], pa.int64()), doc, pa.array(best.score, pa.int64())], names=["item", "doc", "score"]
        )

    return docs.mapInArrow(run, "item bigint, doc bigint, score bigint")


def search(
    items: DataFrame, docs: DataFrame, k: int = 10, item_key: str = "item_id", key: str = "doc_id", text: str = "text",
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """``item_key, rank, key, score``: the ``k`` documents with the highest score above 0 for each row of ``items``.

    ``key`` is an integer; ``text`` names the text column of both frames.
    """
    spark = docs.sparkSession
    small_batches(spark)
    asked = items.select(F.col(item_key).alias("own"), F.col(text).alias("text"))
    asked = cut_lineage(dense_ids(asked, ["own", "text"], "item", start=0))
    rows = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text"))
    parts = [spark.createDataFrame([], "item bigint, doc bigint, score bigint")]
    for low in range(0, asked.count(), block_items):
        members = asked.where(F.col("item").between(low, low + block_items - 1)).select("item", "text").collect()
        block = spark.sparkContext.broadcast(ItemBlock.of([tuple(row) for row in members]))
        documents, terms, holding = _statistics(rows, block)
        parts.append(cut_lineage(_scored(rows, block, documents, terms, weights(documents, holding), k)))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item", "own"), "item").select(
        F.col("own").alias(item_key), "rank", F.col("doc").alias(key), "score"
    )
