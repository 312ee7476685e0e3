"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry
from check import TABLES, compare
from workload.oracles import ORACLES
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    got = df.select(*[f"`{c}`" for c in sorted(df.columns)]).toPandas()
    want = duck.execute(ORACLES[name]).df()
    assert compare(got, want[sorted(want.columns)]) is None


def test_entry(spark):
    df = entry(spark)
    assert df.schema == entry(spark).schema
    assert df.count() > 0
