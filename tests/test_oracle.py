"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _sortable(row):
    return tuple(
        (value is None, str(type(value)), "" if value is None else value)
        if not (isinstance(value, float) and math.isnan(value))
        else (False, "nan", "")
        for value in row
    )


def test_every_query_has_sql():
    assert set(contract.QUERIES) == set(contract.ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("key", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, duck, key):
    found = contract.queries()[key](spark, SF_DIR)
    expected = duck.execute(contract.oracle_sql()[key])
    names = sorted(found.columns)
    types = {d[0]: str(d[1]) for d in expected.description}
    assert names == sorted(types)
    assert {c: SPARK_TYPES[t] for c, t in found.dtypes} == types
    order = [list(types).index(c) for c in names]
    right = sorted(
        (tuple(row[i] for i in order) for row in expected.fetchall()), key=_sortable
    )
    left = sorted((tuple(row) for row in found.select(*names).collect()), key=_sortable)
    assert len(left) == len(right)
    assert left == right
