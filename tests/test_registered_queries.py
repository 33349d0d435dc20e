"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from catalogue import QUERIES, SQL

from .compare import connect, differences, duckdb_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    found = spark_rows(QUERIES[name](spark, SF_DIR))
    assert differences(found, duckdb_rows(duck, SQL[name])) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0
    assert set(entry_point.queries()) >= set(entry_point.oracle_sql())
