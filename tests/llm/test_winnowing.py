"""Winnowing against a plain version, its guarantee, and the walk along consecutive documents."""

import hashlib
import random

import numpy as np
import pytest

from tarmac.llm import winnowing
from tarmac.llm.winnowing import GRAM, WINDOW


def plain(text, gram, window):
    hashes = [int(h) for h in winnowing.gram_hashes(text, gram)]
    chosen = set()
    for low in range(max(1, len(hashes) - window + 1) if hashes else 0):
        part = hashes[low : low + window]
        chosen.add(low + max(i for i, h in enumerate(part) if h == min(part)))
    return [(hashes[i], i) for i in sorted(chosen)]


@pytest.mark.parametrize("gram,window", [(1, 1), (2, 3), (5, 8), (GRAM, WINDOW)])
def test_choice_equals_plain_version(gram, window):
    rnd = random.Random(gram)
    for n in (0, 1, 2, 5, 17, 40, 300):
        text = "".join(rnd.choice("abé😀 ") for _ in range(n))
        hashes, positions = winnowing.winnow(text, gram, window)
        assert list(zip(hashes.tolist(), positions.tolist())) == plain(text, gram, window)


def test_equal_grams_hash_alike_wherever_they_stand():
    text = "the same words " * 40
    hashes = winnowing.gram_hashes(text, 15)
    assert len(set(hashes.tolist())) == 15


def test_long_passages_always_share_a_hash():
    rnd = random.Random(3)
    letters = "abcdefgh "
    for _ in range(200):
        shared = "".join(rnd.choice(letters) for _ in range(GRAM + WINDOW - 1))
        a, b = ("".join(rnd.choice(letters) for _ in range(rnd.randrange(200))) for _ in range(2))
        left, right = (winnowing.winnow(x + shared + y)[0] for x, y in ((a, b), (b, a)))
        assert len(np.intersect1d(left, right))


def brute(rows):
    """Expected (doc_id, n_chars, edited text, next text) along (doc_id, text) rows sorted by id."""
    out = []
    for i, (key, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        tail = len(text) // 4
        out.append((key, len(text), text[: len(text) - tail] + following[:tail], following))
    return out


@pytest.mark.parametrize("run_rows", [1, 3, 1024])
def test_next_document_across_runs(make_docs, monkeypatch, run_rows):
    monkeypatch.setattr(winnowing, "RUN_ROWS", run_rows)
    rnd = random.Random(run_rows)
    ids = rnd.sample(range(-50, 1000), 60)
    rows = [(i, rnd.choice([None, "", "é😀", "".join(rnd.choice("abcd ") for _ in range(rnd.randrange(400)))])) for i in ids]
    got = {r.doc_id: r for r in winnowing.compare_with_next(make_docs(rows)).collect()}
    assert len(got) == len(rows)
    for (key, n, edited, following), (_, text) in zip(brute(sorted(rows)), sorted(rows)):
        own, changed, other = (winnowing.winnow(t) for t in (text, edited, following))
        assert got[key].n_chars == n
        assert got[key].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[key].fingerprint == winnowing.as_string(*own)
        assert got[key].edited_fingerprint == winnowing.as_string(*changed)
        for value, against in ((got[key].near_edited, changed), (got[key].near_next, other)):
            a, b = set(own[0].tolist()), set(against[0].tolist())
            assert value == (len(a & b) / len(a | b) if a | b else 1.0)


def test_one_document_follows_itself(make_docs):
    (row,) = winnowing.compare_with_next(make_docs([(4, "abcdefgh")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and row.near_next == 1.0


def test_null_and_repeated_ids(make_docs):
    rows = [(None, "x" * 40), (1, "y" * 40), (1, "z" * 40), (1, "z" * 40), (None, None)]
    got = winnowing.compare_with_next(make_docs(rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in got) == [
        (False, 1, 40), (False, 1, 40), (False, 1, 40), (True, 0, 0), (True, 0, 40),
    ]


def test_empty_table(make_docs):
    assert winnowing.compare_with_next(make_docs([])).count() == 0


def test_arrays_replace_columns_of_their_name(make_docs):
    docs = make_docs([(1, "some words"), (2, None)]).withColumnRenamed("lang", "hashes")
    got = {r.doc_id: r for r in winnowing.add_fingerprints(docs).collect()}
    assert got[2].hashes == [] and got[1].positions == [0]
