"""Queries of the corpus operators that SQL can express give the SQL's rows."""

import math
from pathlib import Path

import duckdb
import pytest

from tidewater.llm import registry

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no tables")


def plain(v):
    return (None if math.isnan(v) else round(v, 9)) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_twin(spark, name):
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    df = registry.QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    twin = con.execute(registry.ORACLES[name])
    names = [c[0] for c in twin.description]
    assert sorted(names) == columns
    assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr) == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in twin.fetchall()), key=repr)
