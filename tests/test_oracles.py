"""Every query with SQL gives the same rows as DuckDB on the same tables."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

from fathomgrid.plans import corpus, corpus_sql, exports, reference  # noqa: F401

SQL = corpus_sql.ORACLES | reference.ORACLES
QUERIES = corpus.QUERIES | reference.QUERIES


@pytest.fixture(scope="module")
def duck(folder):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for f in os.listdir(folder):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{f}'")
    return c


def plain(value):
    if isinstance(value, float):
        return "nan" if value != value else float(f"{value:.9g}")
    if isinstance(value, list):
        return tuple(map(plain, value))
    return value if isinstance(value, (int, str, type(None))) else str(value)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(name, spark, folder, duck):
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(name, spark, folder):
    assert QUERIES[name](spark, folder).count() >= 0


def test_entry_names_every_query(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
