"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def rows(table):
    """Of an Arrow table, so that a null in a column of numbers doesn't change the others."""
    return sorted(map(str, table.select(sorted(table.column_names)).to_pylist()))


def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert rows(entry.queries()[name](spark, SF).toArrow()) == rows(duck().sql(entry.oracle_sql()[name]).to_arrow_table())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
