"""Every registered query against DuckDB on the same Parquet tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, SQL = contract.order_queries(), contract.order_sql()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in contract.TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    yield connection
    connection.close()


def sort_key(row):
    return tuple((v is not None, str(type(v)), v) for v in row)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("key", QUERIES)
def test_same_as_sql(spark, duck, key):
    table = QUERIES[key](spark, FOLDER)
    result = duck.execute(SQL[key])
    wanted = {d[0]: str(d[1]) for d in result.description}
    assert {c: TYPES[t] for c, t in table.dtypes} == wanted
    columns = sorted(table.columns)
    rows = [tuple(r) for r in table.select(*[f"`{c}`" for c in columns]).collect()]
    place = [list(wanted).index(c) for c in columns]
    expected = [tuple(r[i] for i in place) for r in result.fetchall()]
    assert len(rows) == len(expected) > 0
    for got, want in zip(sorted(rows, key=sort_key), sorted(expected, key=sort_key)):
        for a, b in zip(got, want):
            assert a == b or (isinstance(a, float) and math.isclose(a, b, rel_tol=1e-12)), (got, want)


def test_entry(spark):
    table = contract.entry(spark)
    assert table.columns == contract.FACT_COLUMNS
    assert table.count() == 1500
