"""Every registered query of the engine against its SQL, on the smallest tables."""

import math

import pytest
from meridian.plans.catalogue import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    if isinstance(v, float):
        return str(int(v)) if v.is_integer() else f"{v:.9g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    rows = df.collect()
    if name not in ORACLES:
        assert df.columns and rows
        return
    got = duck.execute(ORACLES[name])
    cols = [c[0] for c in got.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted(tuple(plain(r[cols.index(c)]) for c in df.columns) for r in got.fetchall())
    assert sorted(tuple(plain(v) for v in r) for r in rows) == want


def test_entry():
    import __spark_entry__ as entry

    assert set(ORACLES) <= set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())
