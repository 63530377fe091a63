"""Every query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import check

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    got = check.rows(df.columns, [tuple(r) for r in df.collect()])
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    result = duck.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == check.rows(columns, result.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
