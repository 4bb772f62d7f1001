"""Manifests against a plain Merkle tree."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tarmac.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def digest(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """Root, and per leaf the (left, right) siblings of each level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            low = i // 3 * 3
            paths[leaf].append(("".join(nodes[low:i]), "".join(nodes[i + 1 : low + 3])))
        nodes = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        at = [i // 3 for i in at]
    return nodes[0], paths


def plain(rows):
    """(doc_id, source, leaf, subroot, root, path) of (doc_id, text, lang, source, n_chars) rows, sorted."""
    groups = {}
    for doc_id, text, lang, source, n in rows:
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, digest((doc_id, source, lang, n, text)), doc_id))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    built = {name: tree([r[2] for r in sorted(groups[name])]) for name in names}
    root, crowns = tree([built[name][0] for name in names]) if names else (None, [])
    out = []
    for name, crown in zip(names, crowns):
        subroot, paths = built[name]
        for row, path in zip(sorted(groups[name]), paths):
            out.append((row[3], name, row[2], subroot, root, path + crown))
    return sorted(out, key=repr)


def made(docs, **options):
    rows = merkle.manifest(docs, FIELDS, **options).collect()
    return sorted(
        ((r.doc_id, r.source, r.leaf, r.subroot, r.root, [tuple(p) for p in r.path]) for r in rows), key=repr
    )


def as_rows(df):
    return [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()]


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_like_a_plain_tree(make_docs, levels):
    rng = random.Random(levels)
    rows = [(i, f"text {i} é\n" * rng.randint(0, 3), "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(120)]
    rows += [(500, "alone", "one"), (501, None, None), (None, "", None), (None, None, "hot"), (7, "again", "hot")]
    rows += [(9, "same row", "hot")] * 4 + [(600, "long " * 200_000, "s1")]
    docs = make_docs(rows).repartition(5)
    assert made(docs, levels=levels) == plain(as_rows(docs))


def test_sizes_around_powers(make_docs):
    sizes = [1, 2, 3, 4, 9, 10, 27, 28]
    docs = make_docs([(100 * n + i, str(i), f"of {n}") for n in sizes for i in range(n)])
    assert made(docs, levels=2) == plain(as_rows(docs))


def test_many_groups_need_rounds_of_their_own(make_docs):
    docs = make_docs([(i, str(i), f"source {i}") for i in range(40)])
    assert made(docs, levels=1) == plain(as_rows(docs))


def test_empty_table(make_docs):
    assert made(make_docs([])) == []


def test_fold_finds_changed_rows(make_docs):
    docs = make_docs([(i, f"line\n{i}", "a" if i < 8 else "b") for i in range(11)])
    written = merkle.manifest(docs, FIELDS)
    now = docs.where("doc_id <> 10").withColumn("text", F.when(F.col("doc_id") == 3, "other").otherwise(F.col("text")))
    state = {r.doc_id: (r.verified, r.folded_root is None) for r in merkle.audit(now, written, FIELDS).collect()}
    assert state == {i: (i not in (3, 10), i == 10) for i in range(11)}


def test_other_columns_take_no_part(make_docs):
    docs = make_docs([(i, f"t{i}", "a") for i in range(5)])
    noisy = docs
    for name in ("leaf", "root", "path", "tree", "pos", "node", "name", "load", "n", "tie", "part", "row"):
        noisy = noisy.withColumn(name, F.lit(1))
    assert made(noisy) == made(docs)


def test_carried_columns(make_docs):
    docs = make_docs([(1, "a\nb", "x"), (2, "c", "x")])
    rows = merkle.manifest(docs, FIELDS, carry={"size": F.length("text"), "upper": F.upper("text")}).collect()
    assert {r.doc_id: (r["size"], r.upper) for r in rows} == {1: (3, "A\nB"), 2: (1, "C")}


def test_proof_digest_of_a_lone_leaf(make_docs):
    (row,) = merkle.manifest(make_docs([(1, "x", "a")]), FIELDS).select("leaf", "root", merkle.proof_digest(F.col("path")).alias("p")).collect()
    assert row.leaf == row.root and row.p == h("")
