"""Token counts by rank-synchronous merging in ragged arrays.

The pre-tokens of a batch of texts, each kind once, lie one after the other in one array of symbols.  In every round each
sequence finds its pair of lowest rank, all sequences merge all places of their pair at the same time, and sequences
without a pair leave the array.  What survives is counted; symbols are never written out as tokens.

Defined cases: null and empty texts have 0 bytes and tokens.  The string of a special token inside a text is one token, as
the library's default has it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from tarmac.llm.batches import small_batches

#: The split of byte-level pre-tokenizers of this kind (fixed by the format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ROWS = 256
_CACHED = 300_000
_NONE = np.int64(1) << 40


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the others counted up from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class TokenCounter:
    """Counts tokens under a byte-level BPE vocabulary in the library's JSON format."""

    def __init__(self, vocabulary: str) -> None:
        content = json.loads(vocabulary)
        kind = content["pre_tokenizer"]
        if content["normalizer"] or kind["type"] != "ByteLevel" or kind["add_prefix_space"] or not kind["use_regex"]:
            raise ValueError("only byte-level vocabularies without normalizer and prefix space are counted here")
        ids = content["model"]["vocab"]
        self._symbol = np.array([ids[c] for c in byte_symbols()], dtype=np.int64)
        self._base = max(ids.values()) + 1
        merges = [(m if isinstance(m, list) else m.split(" ")) for m in content["model"]["merges"]]
        pairs = np.array([ids[a] * self._base + ids[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(pairs, kind="stable")
        self._pairs, self._rank = pairs[order], order
        self._merged = np.array([ids[a + b] for a, b in merges], dtype=np.int64)
        special = [t["content"] for t in content["added_tokens"]]
        self._special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self._cut = regex.compile(PATTERN)
        self._cache: dict[str, int] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self._base + right
        at = np.minimum(np.searchsorted(self._pairs, wanted), len(self._pairs) - 1)
        return np.where(self._pairs[at] == wanted, self._rank[at], _NONE)

    def count_pieces(self, pieces: list[str]) -> np.ndarray:
        """Symbols left of each piece when no pair has a rank."""
        encoded = [p.encode() for p in pieces]
        lengths = np.array([len(e) for e in encoded], dtype=np.int64)
        counts = lengths.copy()
        symbols = self._symbol[np.frombuffer(b"".join(encoded), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), lengths)
        while len(symbols) > 1:
            ranks = np.full(len(symbols), _NONE)
            inside = owner[1:] == owner[:-1]
            ranks[:-1][inside] = self._ranks(symbols[:-1][inside], symbols[1:][inside])
            # lowest rank of each sequence, at all its symbols
            starts = np.flatnonzero(np.concatenate(([True], ~inside)))
            sizes = np.diff(np.append(starts, len(symbols)))
            least = np.repeat(np.minimum.reduceat(ranks, starts), sizes)
            counts[owner[starts]] = sizes
            hit = (ranks == least) & (ranks != _NONE)
            if not hit.any():
                break
            # in a run of adjacent hits (aaa) every second one, from the first on, merges
            place = np.arange(len(hit))
            since = np.maximum.accumulate(np.where(hit, 0, place + 1))
            hit &= (place - since) % 2 == 0
            symbols[hit] = self._merged[ranks[hit]]
            gone = np.concatenate(([False], hit[:-1]))
            stays = (least != _NONE) & ~gone
            counts[owner[starts]] -= np.add.reduceat(hit.astype(np.int64), starts)
            symbols, owner = symbols[stays], owner[stays]
        return counts

    def forget(self) -> None:
        """Free the pieces seen; a worker lives on after its task."""
        self._cache.clear()

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        totals, listed = [0] * len(texts), []
        for text in texts:
            parts = self._special.split(text) if self._special else [text]
            listed.append((len(parts) - 1, [piece for part in parts for piece in self._cut.findall(part)]))
        cache = self._cache
        new = list({piece for _, pieces in listed for piece in pieces if piece not in cache})
        fresh = dict(zip(new, self.count_pieces(new).tolist()))
        if len(cache) + len(fresh) > _CACHED:
            known = {p: cache[p] for _, pieces in listed for p in pieces if p in cache}
            cache.clear()
            fresh |= known
        cache |= fresh
        for i, (specials, pieces) in enumerate(listed):
            totals[i] = specials + sum(map(cache.__getitem__, pieces))
        return totals


_LOADED: dict[int, TokenCounter] = {}


def _loaded(vocabulary: Broadcast) -> TokenCounter:
    name = hash(vocabulary.value)
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = TokenCounter(vocabulary.value)
    return _LOADED[name]


def _vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """A vocabulary file of fixed size, read where the session runs and sent to all workers."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def count_tokens(docs: DataFrame, vocabulary_path: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """``docs`` without ``text``, with ``n_bytes``, ``n_tokens`` and ``over_limit``, which replace such columns."""
    added = ["n_bytes", "n_tokens", "over_limit"]
    kept = [c for c in docs.columns if c not in (text, *added)]
    vocabulary = _vocabulary(docs.sparkSession, vocabulary_path)
    small_batches(docs.sparkSession)
    schema = docs.selectExpr(*(f"`{c}`" for c in kept), "0L AS n_bytes", "0L AS n_tokens", "true AS over_limit").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _loaded(vocabulary)
        for whole in batches:
            for low in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(low, _ROWS)
                texts = [t.as_py() or "" for t in batch.column(text)]
                sizes = pa.array([len(t.encode()) for t in texts], pa.int64())
                tokens = counter.count(texts)
                columns = [sizes, pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], names=[*kept, *added])
        counter.forget()

    return docs.mapInArrow(run, schema)
