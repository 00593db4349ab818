"""Every registered query against its SQL twin in DuckDB, as bags of typed rows."""

from __future__ import annotations

import os
from collections import Counter

import pytest

import __spark_entry__
from verification.oracle import ORACLE_SQL
from verification.queries import QUERIES as OWN

duckdb = pytest.importorskip("duckdb")

QUERIES = {name: query for name, query in __spark_entry__.queries().items() if name in OWN}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# Spark's name for each of DuckDB's types used here.
TYPES = {
    "VARCHAR": "string",
    "DOUBLE": "double",
    "FLOAT": "float",
    "DATE": "date",
    "INTEGER": "int",
    "BIGINT": "bigint",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{SF_DIR}/{table}.parquet')"
        )
    return connection


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(OWN) == set(ORACLE_SQL)
    assert set(ORACLE_SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    described = duck.execute(f"describe {ORACLE_SQL[name]}").fetchall()
    types = {column: TYPES[kind] for column, kind, *_ in described}
    assert dict(df.dtypes) == types

    columns = sorted(df.columns)
    rows = duck.execute(f"select {', '.join(columns)} from ({ORACLE_SQL[name]})").fetchall()
    got = Counter(tuple(row) for row in df.select(*columns).collect())
    expected = Counter(rows)
    assert got.total() > 0
    assert sorted(map(str, (got - expected)))[:3] == sorted(map(str, (expected - got)))[:3]
    assert got == expected
