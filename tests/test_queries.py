"""Every registered query of the engine against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from envflow import catalog

DATA = os.environ.get("ENVFLOW_TEST_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, DATA)
    found = duck.execute(catalog.ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(got.columns)
    want = sorted(tuple(plain(r[columns.index(c)]) for c in sorted(columns)) for r in found.fetchall())
    assert sorted(tuple(plain(r[c]) for c in sorted(columns)) for r in got.collect()) == want
