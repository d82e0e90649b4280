"""Every query of the registry against its SQL in DuckDB."""

import os
from pathlib import Path

import pytest

import __spark_entry__ as contract
from registry.oracles import ORACLES
from registry.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no sample tables")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship(spark):
    assert not contract.entry(spark).isEmpty()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, engine, name):
    got = QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    result = engine.execute(ORACLES[name])
    order = [c[0] for c in result.description]
    assert sorted(order) == columns
    want = [tuple(row[order.index(c)] for c in columns) for row in result.fetchall()]
    rows = [tuple(row[c] for c in columns) for row in got.collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
