"""Every query of the library against DuckDB."""

import os

import pytest

import __spark_entry__ as entry_file
from tests.oracle import connect, difference
from tidemark.catalog import ORACLE, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert difference(spark, connection, name, SF_DIR) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_registers_all(spark):
    assert set(QUERIES) <= set(entry_file.queries())
    assert set(entry_file.oracle_sql()) <= set(entry_file.queries())


def test_entry_has_rows(spark):
    assert entry_file.entry(spark).limit(1).count() == 1
