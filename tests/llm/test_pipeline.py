"""The corpus pipeline: stage by stage against plain versions, over odd rows, and the registered queries."""

import base64
import os
import subprocess
import sys

import duckdb  # noqa: F401
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken

import __spark_entry__ as registered
import corpus_pipeline
from tarmac.llm import queries
from tests.llm.test_pii import plain as plain_spans
from tests.llm.test_simhash import brute_components, brute_print
from tests.oracle import compare, database

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_call_the_operators_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "pii", "mixing", "byte_bpe"]


def test_whole_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = {r.doc_id: r for r in docs.collect()}
    current = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        current = spark.createDataFrame(function(spark, current, SF).collect(), docs.schema)
        assert current.columns == COLUMNS, name
        if name == "simhash":
            clean = {r.doc_id for r in stage("toxicity")(spark, docs, SF).collect()}
            groups = brute_components([(i, brute_print(given[i].text)) for i in sorted(clean)])
            assert {r.doc_id for r in current.collect()} == set(groups.values())
        if name == "pii":
            for r in current.collect():
                text, at = "", 0
                for kind, start, end, _ in sorted(plain_spans(given[r.doc_id].text), key=lambda s: (s[1], -s[2])):
                    if start >= at:
                        text += given[r.doc_id].text[at:start] + f"[{kind.upper()}]"
                        at = end
                assert r.text == text + given[r.doc_id].text[at:] and r.n_chars == len(r.text)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r.doc_id, library.encode_ordinary(r.text)) for r in current.collect())
    assert sorted((r.doc_id, r.ids) for r in registered.queries()["pipeline"](spark, SF).collect()) == want


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows_and_empty_tables(spark, make_docs, name):
    rows = [(None, None), (1, ""), (1, ""), (2, "a b c", None), (None, "x@y.zz"), (3, "word " * 30_000)]
    out = stage(name)(spark, make_docs(rows), SF)
    assert {1, 2, 3} <= {r.doc_id for r in out.collect()} or name == "mixing"
    assert stage(name)(spark, make_docs([]), SF).count() == 0


SMALL_HEAP = """
import sys
from pyspark.sql import SparkSession
import corpus_pipeline
at = sys.argv[1]
conf = {"spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.checkpoint.dir": f"{at}/kept", "spark.sql.warehouse.dir": at}
spark = SparkSession.builder.master("local[1]").config(map=conf).getOrCreate()
docs = spark.read.parquet(f"{at}/documents.parquet")
dict(corpus_pipeline.STAGES)[sys.argv[2]](spark, docs, at).write.parquet(f"{at}/out")
print("rows", spark.read.parquet(f"{at}/out").count())
"""


@pytest.mark.parametrize("name", ["toxicity", "pii", "mixing"])
def test_stages_read_long_texts_in_a_small_heap(tmp_path, name):
    # one row group of 2,000 texts of 150,000 characters, 300 MB unpacked
    n = 2_000
    texts = pa.array([f"{i} " + "lorem ipsum " * 12_500 for i in range(n)], pa.string())
    other = {"lang": ["en"] * n, "source": ["a"] * n, "n_chars": pa.array([150_000] * n, pa.int64())}
    docs = pa.table({"doc_id": pa.array(range(n), pa.int64()), "text": texts, **other})
    pq.write_table(docs, tmp_path / "documents.parquet", use_dictionary=False, compression="zstd")
    pq.write_table(pa.table({"doc_id": pa.array([], pa.int64()), "toxic": pa.array([], pa.int32())}), tmp_path / "labels.parquet")
    args = [sys.executable, "-c", SMALL_HEAP, str(tmp_path), name]
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--driver-memory 640m pyspark-shell", "PYTHONPATH": os.pathsep.join(sys.path)}
    done = subprocess.run(args, env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows " in done.stdout, done.stderr[-3000:]
    assert name == "mixing" or f"rows {n}" in done.stdout


@pytest.fixture(scope="module")
def connection():
    return database(SF)


@pytest.mark.parametrize("name", sorted(name for name, (_, sql) in queries.QUERIES.items() if sql))
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, SF, name) == ""


@pytest.mark.parametrize("name", ["op3_url_filters", "op4_mixing", "op10_pii"])
def test_native_queries_run_no_python(spark, name):
    text = registered.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "Arrow"):
        assert word not in text
