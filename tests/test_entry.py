"""Every registered query against its SQL oracle, on the smallest tables."""

import pathlib

import duckdb
import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="no test tables")

# Queries of the optional subpackage have their own tests.
ORACLES = driver._own_oracles()
QUERIES = {name: q for name, q in driver.queries().items() if q in driver._QUERIES}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in pathlib.Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    result = con.execute(ORACLES[name])
    assert sorted(c[0] for c in result.description) == columns
    picks = ", ".join(columns)
    expected = con.execute(f"SELECT {picks} FROM ({ORACLES[name]})").fetchall()
    assert got == sorted(expected, key=repr)


def test_oracles_belong_to_queries():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
