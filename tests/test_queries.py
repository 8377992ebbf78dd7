"""Every registered query that has a SQL twin gives the twin's rows on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from tidewater.plans import catalog, conversions, edits, features  # noqa: F401

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no tables")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return tuple(plain(x) for x in v) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_twin(spark, db, name):
    df = catalog.QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    found = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    twin = db.execute(catalog.ORACLES[name])
    names = [c[0] for c in twin.description]
    assert sorted(names) == columns
    assert found == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in twin.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, str(DATA)).count() >= 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
