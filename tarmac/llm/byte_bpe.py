"""Byte-level BPE by monoid tree reduction.

The encoding of a piece is a monoid: halves are encoded recursively and joined.  A join encodes a window of tokens on both
sides of the border anew and lets it grow until the tokens outside provably stay: a sequence of tokens is the
encoding of its bytes exactly if every two neighbours are the encoding of their joint bytes, since the first merge across
a border would also be made with the two tokens alone.  So a window is wide enough once its first and last token pass
that test with their neighbours outside.

Parts of pieces and pairs of neighbours come again and again: the encodings of those met last are remembered.

The same holds one level up: a long text is cut in halves, and the pieces of the halves are joined by cutting the text anew
from the last piece of the left half until a cut meets a cut of the right half; a piece depends only on the text from
its start on, so all later cuts are equal.  Decoding concatenates up the tree.

Defined cases: null and empty texts have no tokens.  Special tokens are ordinary text.  The split pattern must cover every
text, as those of the public byte-level vocabularies do.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from itertools import chain
from typing import Any

import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from tarmac.llm.batches import small_batches

_LEAF_BYTES = 5
_LEAF_CHARS = 1 << 15
_LOOKAHEAD = 3  # code points after its end that a piece may depend on; more than the split pattern looks at
_CACHED = 100_000  # entries that a memory gathers before it lets its older ones go
_CACHED_LENGTH = 64
_NO_RANK = 1 << 31


class _Recent(dict):
    """Values of the keys seen last; a missing one is made.  The older half of the entries goes when there are too many."""

    def __init__(self, make: Callable[[Any], tuple[int, ...]]) -> None:
        super().__init__()
        self._make, self._older = make, {}

    def __missing__(self, key: Any) -> tuple[int, ...]:
        value = self._older.get(key)
        if value is None:
            value = self._make(key)
        if len(key) <= _CACHED_LENGTH:
            if len(self) >= _CACHED:
                self._older = dict(self)
                self.clear()
            self[key] = value
        return value

    def forget(self) -> None:
        self.clear()
        self._older = {}


class ByteBpe:
    """Encoder and decoder of one rank file (a line per token: base64 of its bytes, rank) and split pattern."""

    def __init__(self, rank_file: bytes, pattern: str) -> None:
        lines = (line.split() for line in rank_file.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.numerals = {rank: str(rank) for rank in self.bytes_of}
        self.cut = regex.compile(pattern)
        self._tokens = _Recent(self._piece)
        self._parts = _Recent(self._part)
        self._pairs = _Recent(self._pair)
        self._leaves = _Recent(self._leaf)

    def forget(self) -> None:
        """Let go of the encodings remembered, 100 MB and more in a worker that goes on to other work."""
        for memory in (self._tokens, self._parts, self._pairs, self._leaves):
            memory.forget()

    def _piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        whole = self.ranks.get(data)
        return self._part(data) if whole is None else (whole,)

    def _leaf(self, data: bytes) -> tuple[int, ...]:
        """Merge the lowest rank, leftmost first, until no pair has one."""
        rank = self.ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        joint = [rank(data[i : i + 2], _NO_RANK) for i in range(len(data) - 1)]
        while joint:
            least = min(joint)
            if least == _NO_RANK:
                break
            i = joint.index(least)
            merged = parts[i] + parts.pop(i + 1)
            parts[i] = merged
            del joint[i]
            if i:
                joint[i - 1] = rank(parts[i - 1] + merged, _NO_RANK)
            if i < len(joint):
                joint[i] = rank(merged + parts[i + 1], _NO_RANK)
        return tuple([self.ranks[p] for p in parts])

    def _part(self, data: bytes) -> tuple[int, ...]:
        if len(data) <= _LEAF_BYTES:
            return self._leaves[data]
        half = len(data) // 2
        return self._join(self._parts[data[:half]], self._parts[data[half:]])

    def _pair(self, pair: tuple[int, int]) -> tuple[int, ...]:
        return self._leaves[self.bytes_of[pair[0]] + self.bytes_of[pair[1]]]

    def _stays(self, left: int, right: int) -> bool:
        """Whether two neighbours are the encoding of their joint bytes."""
        return self._pairs[left, right] == (left, right)

    def encode_bytes(self, data: bytes) -> list[int]:
        """Tokens of one piece."""
        return list(self._part(data))

    def _join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        before, after = 1, 1
        while True:
            before, after = min(before, len(left)), min(after, len(right))
            first = len(left) - before
            if before == after == 1:
                window = self._pairs[left[-1], right[0]]
            else:
                window = self._leaves[b"".join(map(self.bytes_of.__getitem__, left[first:] + right[:after]))]
            stays_left = first == 0 or self._stays(left[first - 1], window[0])
            stays_right = after == len(right) or self._stays(window[-1], right[after])
            if stays_left and stays_right:
                return left[:first] + window + right[after:]
            before, after = before * (1 if stays_left else 2), after * (1 if stays_right else 2)

    def pieces(self, text: str) -> list[str]:
        """The matches of the pattern, in order."""
        if len(text) <= _LEAF_CHARS:
            return self.cut.findall(text)
        half = len(text) // 2
        return self._join_pieces(self.pieces(text[:half]), self.pieces(text[half:]))

    def _join_pieces(self, left: list[str], right: list[str]) -> list[str]:
        kept, seen = len(left), 0
        while kept and seen < _LOOKAHEAD:  # pieces that end further from the border saw all that they depend on
            kept -= 1
            seen += len(left[kept])
        text = "".join(left[kept:]) + "".join(right)
        fresh, k, cut = [], 0, seen  # the right half's piece k starts at cut
        for match in self.cut.finditer(text):
            while k < len(right) and cut < match.start():
                cut += len(right[k])
                k += 1
            if match.start() == cut:
                return left[:kept] + fresh + right[k:]
            fresh.append(match.group())
        return left[:kept] + fresh

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self._tokens.__getitem__, self.pieces(text))))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= 1 << 12:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_LOADED: dict[tuple[int, str], ByteBpe] = {}


def _loaded(ranks: Broadcast, pattern: str) -> ByteBpe:
    """One encoder per worker and vocabulary."""
    name = (hash(ranks.value), pattern)
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = ByteBpe(ranks.value, pattern)
    return _LOADED[name]


def _vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """A vocabulary file of fixed size, read where the session runs and sent to all workers."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with ``ids`` (array of int); a column ``ids`` of ``docs`` is replaced."""
    kept = [c for c in docs.columns if c not in (text, "ids")]
    ranks = _vocabulary(docs.sparkSession, ranks_path)
    small_batches(docs.sparkSession)
    schema = docs.selectExpr(*(f"`{c}`" for c in kept), "array(0) AS ids").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _loaded(ranks, pattern)
        try:
            for batch in batches:
                ids = pa.array([coder.encode(t.as_py() or "") for t in batch.column(text)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), ids], names=[*kept, "ids"])
        finally:
            coder.forget()

    return docs.mapInArrow(run, schema)


def digest_documents(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per text: number of tokens, SHA-256 of the ids (decimal, joined by a space) and of the bytes decoded from them."""
    ranks = _vocabulary(docs.sparkSession, ranks_path)
    small_batches(docs.sparkSession)
    rows = docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text")
    names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]
    schema = rows.selectExpr("key", "0L AS n_tokens", "'' AS ids_sha256", "'' AS decoded_sha256").schema

    def digest(coder: ByteBpe, body: str) -> tuple[int, str, str]:
        ids = coder.encode(body)
        listed = " ".join(map(coder.numerals.__getitem__, ids)).encode()
        return len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(coder.decode(ids)).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _loaded(ranks, pattern)
        types = [pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            columns = list(zip(*(digest(coder, t.as_py() or "") for t in batch.column("text")))) or [()] * 3
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *arrays], names=names)

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
