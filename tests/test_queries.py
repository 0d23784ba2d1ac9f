"""Every query of the library against its SQL twin on the smallest data set."""

import glob
import os

import duckdb
import pytest

from check_oracle import rows_of
from shardloom.plans import load_all
from shardloom.plans.registry import ORACLES, QUERIES

load_all()

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    got = [tuple(r) for r in df.collect()]
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, got) == rows_of(names, result.fetchall())
