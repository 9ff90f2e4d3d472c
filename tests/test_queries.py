"""Registered queries against their SQL, and streams against batch."""
import math

import duckdb
import pytest
from pathlib import Path

import __spark_entry__ as entry

SLOW = {"detect_reviews", "scored_output", "model_round_trip", "feature_importance", "feature_contributions", "explain",
        "base_prob", "token_contributions"}  # covered by test_models


def plain(v):
    return ("nan" if math.isnan(v) else repr(v + 0.0)) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", [n for n in entry.queries() if n in entry.oracle_sql()])
def test_query_equals_sql(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    rel = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(tuple(plain(dict(zip(names, r))[c]) for c in df.columns) for r in rel.fetchall())
    assert sorted(tuple(plain(v) for v in r) for r in df.collect()) == want


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in entry.oracle_sql() and n not in SLOW])
def test_query_runs(spark, sf, name):
    assert entry.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 22


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
