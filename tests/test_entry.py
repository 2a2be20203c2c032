"""Driver contract: entry() runs; every query with an oracle matches DuckDB at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from data_dirs import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "alert_id" in df.columns


def test_every_query_has_a_callable():
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs)
    assert len(qs) >= 50


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF001)
    rel = duck.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())
