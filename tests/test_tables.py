"""Every registered query against plain SQL in an independent engine, over whole tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from catalog_engine.plans.table_queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    return repr(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    found = contract.queries()[name](spark, FOLDER)
    expected = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in expected.description]
    left = sorted_rows(found.columns, found.collect())
    right = sorted_rows(columns, expected.fetchall())
    assert left[0] == right[0]
    assert len(left[1]) == len(right[1])
    assert [p for p in zip(left[1], right[1]) if p[0] != p[1]][:3] == []


def test_every_query_is_compared():
    assert set(QUERIES) <= set(contract.queries()) & set(contract.oracle_sql())
