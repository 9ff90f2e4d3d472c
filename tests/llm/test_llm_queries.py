"""Registered queries of this package against their SQL."""
from pathlib import Path

import duckdb
import pytest

from tellmark.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, name, size):
    con, sf = duckdb.connect(), f"/root/testdata/{size}"
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    df = QUERIES[name](spark, sf)
    rel = con.execute(ORACLES[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(map(str, (tuple(dict(zip(names, r))[c] for c in df.columns) for r in rel.fetchall())))
    assert sorted(str(tuple(r)) for r in df.collect()) == want
