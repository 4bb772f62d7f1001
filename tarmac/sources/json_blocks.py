"""Elements of one array of large JSON documents, read by many tasks whatever the layout.

A file is read in blocks, and a block in fragments that end at a closing brace.  What a block does to the lexer's state is
found without knowing the state it starts in: it turns the "inside a string" flag over or not, and changes the depth by
one amount if it starts outside a string and another if inside.  These effects compose, so sums over the earlier blocks of a
file give every block its starting state.  With that, each block finds the borders of the elements in it; the only thing
it may not know is which container it starts in, and that is what the last earlier block says that saw one open or close.
Elements between two borders of a block are complete; the pieces at its ends are put together by their number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tarmac.session import cut_lineage

_STRING_REST = re.compile(rb'[^"\\]*(?:\\.[^"\\]*)*("|$)', re.S)
_TOKEN = re.compile(rb'"[^"\\]*(?:\\.[^"\\]*)*(?:"|$)|[\[\]{,]', re.S)
_ESCAPE = re.compile(rb"\\.", re.S)
_OPENS = re.compile(rb"\s*:\s*(?=\[)")
_EFFECT = "path string, block bigint, turns int, outside bigint, inside bigint, wrapped boolean"
_PIECE = (
    "path string, block bigint, here boolean, k bigint, text binary, starts boolean, ends boolean, "
    "state string, done boolean, borders bigint, borders_here bigint"
)


def _fragments(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Texts between closing braces, in the order of the file within a partition."""
    return spark.read.option("lineSep", "}").text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("text"),
    )


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[bytes]]]:
    """Runs of rows of one block, as (all columns but the text, texts); a partition may hold several blocks."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in batch.schema.names if c != "text"), batch.column("text"))

    source = rows()
    row = next(source, None)
    while row is not None:
        head = row[:-1]

        def texts() -> Iterator[bytes]:
            nonlocal row
            while row is not None and row[:2] == head[:2]:
                yield row[-1].as_py()
                row = next(source, None)

        own = texts()
        yield head, own
        for _ in own:
            pass


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block does to the state, for both ways it may start."""
    found = []
    for (path, block), texts in _by_block(batches):
        inside, depths, wrapped = False, [0, 0], None
        for text in texts:
            if wrapped is None and text.strip():
                wrapped = text.removeprefix(b"\xef\xbb\xbf").lstrip().startswith(b"[")
            parts = (_ESCAPE.sub(b"", text) if b"\\" in text else text).split(b'"')
            turns = len(parts) % 2 == 0
            for start in (0, 1):  # outside and inside a string at the start of the block
                plain = parts[int(inside) ^ start :: 2]
                depths[start] += sum(p.count(b"{") + p.count(b"[") - p.count(b"]") for p in plain)
                depths[start] -= not (inside ^ bool(start) ^ turns)
            inside ^= turns
        found.append((path, block, int(inside), *depths, bool(wrapped)))
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(list(zip(*found)) or [()] * 6, (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()))],
        names=["path", "block", "turns", "outside", "inside", "wrapped"],
    )


class _Lexer:
    """Pieces of the elements of array ``key`` in one block, given the state it starts in."""

    def __init__(self, key: str, inside: bool, depth: int, wrapped: bool) -> None:
        self.key, self.inside, self.depth = b'"' + key.encode() + b'"', inside, depth
        self.within = 3 if wrapped else 2  # depth between the elements
        # True in the array, False out of it, None in a container that an earlier block opened
        self.active: bool | None = None if depth >= self.within else False
        self.done = False  # the document's object has ended
        self.here, self.k, self.borders, self.borders_here = False, 0, 0, 0
        self.piece: list[bytes] = []
        self.starts = False

    def _piece(self, ends: bool) -> tuple:
        made = (self.here, self.k, b"".join(self.piece), self.starts, ends)
        self.piece = []
        return made

    def feed(self, text: bytes) -> Iterator[tuple]:
        """Read a fragment and the brace after it."""
        at = kept = 0
        if self.inside:
            match = _STRING_REST.match(text)
            at = match.end()
            self.inside = not match.group(1)
        opening = False
        if not self.inside and self.depth - text.count(b"]") > self.within:
            # nothing in this fragment can come back to where the elements are
            parts = (_ESCAPE.sub(b"", text[at:]) if b"\\" in text else text[at:]).split(b'"')
            self.depth += sum(p.count(b"{") + p.count(b"[") - p.count(b"]") for p in parts[::2])
            self.inside = len(parts) % 2 == 0
            at = len(text)
        while not self.inside and (match := _TOKEN.search(text, at)):
            token, at = match.group(), match.end()
            first = token[:1]
            if first == b'"':
                if len(token) == 1 or not token.endswith(b'"') or (len(token) - len(token[:-1].rstrip(b"\\")) - 1) % 2:
                    self.inside = True
                elif self.depth == self.within - 1 and token == self.key and not self.done:
                    opening = _OPENS.match(text, at) is not None
            elif first == b"]":
                self.depth -= 1
                if self.depth == self.within - 1 and self.active is not False:
                    self.piece.append(text[kept : match.start()])
                    yield self._piece(True)
                    self.active = False
            elif first == b",":
                if self.depth == self.within and self.active is not False:
                    self.piece.append(text[kept : match.start()])
                    yield self._piece(True)
                    self.k, self.starts, kept = self.k + 1, True, at
                    if self.here:
                        self.borders_here += 1
                    else:
                        self.borders += 1
            else:
                self.depth += 1
                if opening and first == b"[":
                    self.active = self.here = self.starts = True
                    self.k, kept, opening = 0, at, False
        if self.active is not False:
            self.piece.append(text[kept:] + b"}")
        if not self.inside:
            self.depth -= 1
            if self.depth < self.within and self.active is not False:
                yield self._piece(True)  # an unknown container was an object; else the text is broken, as its reader will find
                self.active = False
            if self.depth < self.within - 1:
                self.done, self.active = True, False

    def state(self) -> str | None:
        return None if self.active is None else "open" if self.active else "closed"


def _pieces(key: str):
    """Rows of the pieces of every block, and one without text for what the block leaves behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(schema)
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            rows.clear()
            return made

        rows: list[tuple] = []
        for (path, block, inside, depth, wrapped), texts in _by_block(batches):
            lexer = _Lexer(key, inside, depth, wrapped)
            for text in texts:
                rows += [(path, block, *piece, None, None, None, None) for piece in lexer.feed(text)]
                if len(rows) >= 1000:
                    yield flush()
            if lexer.active is not False and lexer.piece:
                rows.append((path, block, *lexer._piece(False), None, None, None, None))
            rows.append((path, block, None, None, None, None, None, lexer.state(), lexer.done, lexer.borders, lexer.borders_here))
        yield flush()

    kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in _PIECE.split(", "))])
    return run


def array_elements(spark: SparkSession, paths: list[str], key: str) -> DataFrame:
    """``path, ordinal, text`` of the elements of array ``key`` of each document's object, numbered by position.

    A document may stand in an array of its own, whose first element counts.  A file without such an array gives no
    row; one whose array never ends stops the job.
    """
    fragments = _fragments(spark, paths)
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    effects = fragments.mapInArrow(_effects, _EFFECT)
    inside = F.coalesce(F.sum("turns").over(earlier), F.lit(0)) % 2 == 1
    change = F.when(F.col("starts_inside"), F.col("inside")).otherwise(F.col("outside"))
    states = (
        effects.withColumn("starts_inside", inside)
        .withColumn("change", change)
        .select(
            "path", "block", "starts_inside", F.coalesce(F.sum("change").over(earlier), F.lit(0)).alias("depth"),
            F.first("wrapped").over(Window.partitionBy("path").orderBy("block")).alias("wrapped"),
        )
    )
    states = F.broadcast(cut_lineage(states))  # one row per block of a file
    known = fragments.join(states, ["path", "block"]).select("path", "block", "starts_inside", "depth", "wrapped", "text")
    pieces = cut_lineage(known.mapInArrow(_pieces(key), _PIECE))
    # one row per block: whether the array was open when it began, and how many borders came before
    left = pieces.where("text IS NULL").withColumns(
        {
            "entered": F.coalesce(F.last("state", ignorenulls=True).over(earlier) == "open", F.lit(False)),
            "over": F.coalesce(F.max("done").over(earlier), F.lit(False)),
        }
    )
    passed = F.when(F.col("over"), 0).otherwise(F.col("borders_here") + F.when(F.col("entered"), F.col("borders")).otherwise(0))
    left = left.withColumn("passed", passed).select(
        F.col("path").alias("p"), F.col("block").alias("b"), "entered", "over",
        F.coalesce(F.sum("passed").over(earlier), F.lit(0)).alias("before"),
        F.when(F.col("entered"), F.col("borders")).otherwise(0).alias("own"),
    )
    held = pieces.where("text IS NOT NULL").join(
        F.broadcast(cut_lineage(left)), (F.col("path") == F.col("p")) & (F.col("block") == F.col("b"))
    ).where(~F.col("over") & (F.col("here") | F.col("entered")))
    numbered = held.select(
        "path", "block", (F.col("before") + F.col("k") + F.when(F.col("here"), F.col("own")).otherwise(0)).alias("ordinal"),
        "text", "ends", (F.col("starts") & F.col("ends")).alias("complete"),
    )
    whole = numbered.where("complete").select("path", "ordinal", "text")
    joined = numbered.where("NOT complete").groupBy("path", "ordinal").agg(
        F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts"), F.max("ends").alias("ended")
    )
    unfinished = F.raise_error(F.concat(F.lit("unfinished array in "), F.col("path"))).cast("binary")
    together = F.aggregate("parts", F.lit(b""), lambda text, part: F.concat(text, part["text"]))
    stitched = joined.select(
        "path", "ordinal", F.when(F.col("ended"), together).otherwise(unfinished).alias("text")
    )
    texts = whole.unionByName(stitched).withColumn("text", F.btrim(F.col("text").cast("string"), F.lit(" \t\r\n")))
    return texts.where("text <> ''")  # an empty array has one blank piece
