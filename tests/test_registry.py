"""Every registered query against the same result in SQL."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def canonical(columns, data):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(row[i] for i in places) for row in data]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, FOLDER)
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    if name not in registry.oracle_sql():
        assert mine
        return
    result = duck.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    theirs = canonical(columns, result.fetchall())
    assert len(mine) == len(theirs)
    for a, b in zip(mine, theirs):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, (int, float)):
                assert math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9), (a, b)
            else:
                assert x == y, (a, b)


def test_entry(spark):
    assert registry.entry(spark).count() == 5


def test_oracles_belong_to_queries():
    assert set(registry.oracle_sql()) <= set(registry.queries())
