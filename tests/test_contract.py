"""The driver contract, and queries against their SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from check import rows
from workload.oracles import ORACLES
from workload.queries import QUERIES

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.sql(f"create view {file.stem} as select * from '{file}'")
    return connection


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["commit_key", "prompt", "target"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    got = contract.queries()[name](spark, str(FOLDER)).toPandas()
    want = db.sql(contract.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0
    assert rows(got) == rows(want)
