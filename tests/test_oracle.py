"""Every registered query against its SQL text in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as contract
from estate_hygiene.registry import registered
from oracle.queries import oracle_queries

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_an_oracle():
    assert registered().keys() == oracle_queries().keys()
    assert registered().keys() <= contract.queries().keys() and contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", list(registered()))
def test_same_rows(spark, duck, name):
    df = contract.queries()[name](spark, SMALL)
    relation = duck.sql(contract.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    types = dict(df.dtypes)
    assert {c: TYPES[types[c]] for c in columns} == dict(zip(relation.columns, map(str, relation.types), strict=True))
    expected = relation.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert ordered(tuple(r[c] for c in columns) for r in df.collect()) == ordered(expected)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 50
