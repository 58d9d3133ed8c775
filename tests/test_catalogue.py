"""Every registered query against its SQL, over whole tables."""

import os

import pytest
from oracle import duckdb_rows, spark_rows

import __spark_entry__ as entry
from flowtables.plans import catalogue

SF_DIR = os.environ.get("FLOWTABLES_TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert set(catalogue.ORACLES) == set(catalogue.QUERIES)
    assert set(catalogue.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_agrees_with_sql(spark, name):
    columns, rows = spark_rows(entry.queries()[name](spark, SF_DIR))
    expected_columns, expected = duckdb_rows(entry.oracle_sql()[name], SF_DIR)
    assert columns == expected_columns
    assert len(rows) > 0
    assert rows == expected


def test_entry_reassembles_flows(spark):
    result = entry.entry(spark)
    assert "content_md5" in result.columns
    assert result.filter("outcome = 'success'").count() > 0
