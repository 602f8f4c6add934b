"""Every query with SQL agrees with DuckDB on the smallest tables; the others give rows."""

import pytest
from oracle_check import oracle_connection, run

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_entry_is_stable(spark):
    df = entry.entry(spark)
    assert df.columns == ["pos", "bucket_end", "amount"]
    assert df.count() == 12


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    assert run(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF) == ""


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_gives_rows(spark, con, name):
    assert run(spark, con, name, entry.queries()[name], None, SF) == ""
