"""Byte-level BPE and token counts against the public libraries."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarmac.llm import byte_bpe, token_counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


def texts():
    rnd = random.Random(11)
    letters = "aaabn '’sreldvm  \n\t é漢😀٣²ͅ <|endoftext|>09.-_"
    made = ["".join(rnd.choice(letters) for _ in range(rnd.choice([1, 5, 40, 400]))) for _ in range(200)]
    made += ["".join(chr(rnd.randrange(1, 0xD7FF)) for _ in range(50)) for _ in range(100)]
    return made + [
        "", "a" * 20000, " " * 3000 + "x", "'re" * 9000, "<|endoftext|>x<|endoftext|>", "ab" * 9000 + "é" * 3000,
        "word it's " * 4000 + "z", "".join(rnd.choice("thesandio ") for _ in range(40000)),
    ]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def coder():
    with open(RANKS, "rb") as file:
        return byte_bpe.ByteBpe(file.read(), public_tokenizers.PATTERN)


@pytest.mark.parametrize("chars,leaf", [(1 << 15, 5), (8, 5), (64, 1), (1 << 15, 32)])
def test_encoding_equals_library(library, monkeypatch, chars, leaf):
    """Whatever the size of the leaves, the tree gives the library's ids, and they decode to the text."""
    monkeypatch.setattr(byte_bpe, "_LEAF_CHARS", chars)
    monkeypatch.setattr(byte_bpe, "_LEAF_BYTES", leaf)
    own = coder()
    for text in texts():
        if chars < 100 and len(text) > 400:
            continue
        ids = own.encode(text)
        assert ids == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_digests_and_ids(make_docs, library):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, None), (0, "again")]
    got = byte_bpe.digest_documents(make_docs(rows), RANKS, public_tokenizers.PATTERN).collect()
    want = []
    for key, text in rows:
        ids = library.encode_ordinary(text or "")
        listed = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append((key, len(ids), listed, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    docs = make_docs(rows).withColumn("ids", F.lit("clash"))
    encoded = byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN)
    assert sorted((r.ids for r in encoded.collect())) == sorted(library.encode_ordinary(t or "") for _, t in rows)


@pytest.mark.parametrize("rows", [1, 256])
def test_counts_equal_library(make_docs, monkeypatch, rows):
    monkeypatch.setattr(token_counts, "_CACHED", 500 if rows == 1 else 300_000)
    monkeypatch.setattr(token_counts, "_ROWS", rows)
    listed = [(i, t) for i, t in enumerate(texts())] + [(None, None)]
    docs = make_docs(listed).withColumn("n_tokens", F.lit("clash"))
    got = token_counts.count_tokens(docs.select("doc_id", "text", "n_tokens"), JSON).collect()
    tokenizer = Tokenizer.from_file(JSON)
    want = [
        (key, len((text or "").encode()), n := len(tokenizer.encode(text or "", add_special_tokens=False).ids), n > 1024)
        for key, text in listed
    ]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got), key=str) == sorted(want, key=str)


def test_empty_tables(make_docs):
    docs = make_docs([])
    assert byte_bpe.digest_documents(docs, RANKS, public_tokenizers.PATTERN).count() == 0
    assert token_counts.count_tokens(docs, JSON).count() == 0


def test_vocabulary_of_another_kind_is_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        content = file.read()
    with pytest.raises(ValueError):
        token_counts.TokenCounter(content)


def test_encoding_leaves_no_memories_in_a_worker(spark):
    """A worker that goes on to other work keeps the vocabulary, not the encodings of the texts it met."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts()[:50])], "doc_id int, text string").coalesce(1)

    def left(batches):
        import pyarrow as pa

        list(batches)
        kept = [len(m) + len(m._older) for c in byte_bpe._LOADED.values() for m in (c._tokens, c._parts, c._pairs, c._leaves)]
        yield pa.RecordBatch.from_pydict({"n": [sum(kept)]})

    assert byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN).collect()
    for _ in range(3):
        assert spark.range(8).repartition(8).mapInArrow(left, "n long").agg(F.max("n")).first()[0] == 0
