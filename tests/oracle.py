"""Run registered queries next to their SQL: ``python -m tests.oracle <sf_dir> [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

import __spark_entry__ as registered

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(spark, con, sf_dir: str, name: str) -> str:
    """Empty when both sides agree, else what differs."""
    df = registered.queries()[name](spark, sf_dir)
    got_columns, got = _rows(df.columns, df.collect())
    result = con.execute(registered.oracle_sql()[name])
    want_columns, want = _rows([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} / {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w or list(map(type, g)) != list(map(type, w))]
    return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}" if wrong else ""


if __name__ == "__main__":
    from tarmac.session import local_session

    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    folder, names = sys.argv[1], sys.argv[2:] or list(registered.queries())
    connection, bad = database(folder), 0
    for query in names:
        begin = time.time()
        try:
            difference = compare(session, connection, folder, query)
        except Exception as error:  # report and go on
            difference = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(difference)
        print(f"{query:28s} {time.time() - begin:6.1f}s {difference or 'ok'}", flush=True)
    sys.exit(bool(bad))
