"""Registered queries against their DuckDB oracle at sf0.001 (the driver runs the same at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from featurekit.oracle import oracle_sql
from featurekit.sources.tables import TABLES
from tests.conftest import SF_SMALL

HEAVY = {"split_scan", "halving"}


def canon(cols, rows):
    def norm(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - HEAVY))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.sql(entry.oracle_sql()[name])
    want = canon(res.columns, res.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["threshold", "precision", "recall", "f1", "accuracy", "auc"]
    assert df.count() == 19
