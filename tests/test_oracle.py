"""Every registered query against its SQL equivalent."""

import pytest

import __spark_entry__ as entry
from tests.compare import duck, spark_rows, sql_rows
from tickseries.plans.catalog import QUERIES
from tickseries.plans.oracle import ORACLES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    want_columns, want = sql_rows(con, ORACLES[name])
    assert columns == want_columns
    assert rows == want


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
