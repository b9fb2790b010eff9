"""Registered queries against their SQL, over a few tables of the smallest size."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from siftworks.plans import catalogue, increments, runs  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    return tuple(map(plain, v)) if isinstance(v, list) else round(v, 9) if isinstance(v, float) else v


def compare(spark, duck, df, sql):
    columns = sorted(df.columns)
    found = duck.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr) == want


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_says_what_its_sql_says(spark, duck, name):
    compare(spark, duck, catalogue.QUERIES[name](spark, SF), catalogue.ORACLE_SQL[name])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
