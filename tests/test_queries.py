"""Each registered query of the engine against its SQL."""

import math
import os

import duckdb
import pytest

from landgauge import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return c


def plain(v):
    if v is None or isinstance(v, str):
        return v
    try:
        f = float(v)
    except (TypeError, ValueError):
        return str(v)
    return None if math.isnan(f) else round(f, 6) + 0.0


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, db, name):
    df = registry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    q = db.execute(sql)
    names = [d[0] for d in q.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(plain(dict(zip(names, r, strict=True))[c]) for c in columns) for r in q.fetchall()), key=str)
