import glob
import os

import duckdb
import pytest

import __spark_entry__ as entries
from compare import normal
from tallyward.checks.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, db, name):
    got = entries.queries()[name](spark, FOLDER).toPandas()
    want = db.execute(entries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)


def test_flagship(spark):
    result = entries.entry(spark)
    assert result.schema == entries.queries()["incident_core"](spark, FOLDER).schema
    assert not result.isEmpty()
