"""Every registered query against its DuckDB oracle SQL on the sf0.001 tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from donorlens.plans.oracle_sql import ORACLE_SQL
from donorlens.plans.queries import QUERIES

STAR = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _norm(v):
    if v is None:
        return "NULL"
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    if isinstance(v, float) and v.is_integer():
        return str(int(v))
    return str(v)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for name in STAR:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(sf_small, name + '.parquet')}')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    """The text operators, where present, have tests of their own."""
    assert set(ORACLE_SQL) == set(QUERIES)
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLE_SQL.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_small, duck, name):
    df = QUERIES[name](spark, sf_small)
    rows = df.collect()
    rel = duck.execute(ORACLE_SQL[name])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    cols = sorted(df.columns)
    idx = {c: i for i, c in enumerate(ocols)}
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in rows)
    want = sorted(tuple(_norm(r[idx[c]]) for c in cols) for r in orows)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["cycle", "party"]
    assert df.count() > 0
