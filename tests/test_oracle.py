"""Every query with SQL gives the rows DuckDB gives; the others give rows."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

# Queries of the corpus operators, if they are there, have tests of their own.
QUERIES = {k: v for k, v in contract.queries().items() if k not in contract.LLM_QUERIES}
ORACLE = {k: v for k, v in contract.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(plain(row[i]) for i in order) for row in rows),
        key=lambda row: [(v is None, str(type(v)), v if v is not None else 0) for v in row],
    )


SPARK_KINDS = {
    "int": "int", "bigint": "int", "double": "float", "string": "text", "date": "date",
    "timestamp": "time", "timestamp_ntz": "time", "boolean": "bool", "float": "float",
}
DUCK_KINDS = {
    "INTEGER": "int", "BIGINT": "int", "DOUBLE": "float", "VARCHAR": "text", "DATE": "date",
    "TIMESTAMP": "time", "BOOLEAN": "bool", "FLOAT": "float",
}


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: DUCK_KINDS[str(d[1])] for d in cursor.description}
    expected = table_of(names, cursor.fetchall())
    assert {c: SPARK_KINDS[t] for c, t in result.dtypes} == kinds
    found = table_of(result.columns, [tuple(r) for r in result.collect()])
    assert len(found) == len(expected) > 0
    assert found == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert len(QUERIES[name](spark, sf_dir).collect()) > 0


def test_entry(spark):
    rows = contract.entry(spark).collect()
    ids = [r["transaction_id"] for r in rows]
    assert rows and len(set(ids)) == len(ids)
    assert all(datetime.date.fromisoformat(r["tx_datetime"]) for r in rows)
