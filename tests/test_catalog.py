"""Every query with an SQL twin against DuckDB, on the smallest of the driver's tables."""

import glob
import math
import os

import pytest

import __spark_entry__
from folioquest.plans import catalog

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_against_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, DATA)
    found = duck.execute(catalog.ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(got.columns)
    want = sorted((tuple(map(plain, r)) for r in found.fetchall()), key=repr)
    assert sorted((tuple(map(plain, r)) for r in got.select(*columns).collect()), key=repr) == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_without_sql(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 20
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
