"""Every registered query against its independent DuckDB SQL at sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    res = con.execute(E.oracle_sql()[key])
    d_cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(d_cols, res.fetchall())


def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert 0 < len(rows) <= 10


def test_every_query_has_an_oracle_or_is_listed():
    assert set(E.QUERIES) - set(E.oracle_sql()) == set(E.NO_ORACLE)
