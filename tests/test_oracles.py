"""Every registered query against its SQL, and the contract of the entry point."""

import re

import pytest

import __spark_entry__ as entry_point
from oracle import connect, differences

QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, folder, tables, name):
    assert differences(QUERIES[name](spark, folder), tables, ORACLES[name]) == []


def test_every_query_of_the_tables_has_sql():
    separate = {n for n in QUERIES if n == "pipeline" or re.match(r"op\d+_", n)}
    assert set(QUERIES) - separate == set(ORACLES) - separate


def test_entry_gives_rows(spark):
    documents = entry_point.entry(spark)
    assert documents.columns[:2] == ["channel", "session_id"]
    assert documents.count() > 0
