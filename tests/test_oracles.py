"""Every registered query with a SQL statement gives the same rows as DuckDB."""

import pytest
from compare import difference, oracle_connection
from retail_helpers import SMALL

import __spark_entry__ as entry
from keepwell.queries import QUERIES
from oracles.statements import ORACLES


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SMALL)


def test_every_statement_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 150


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SMALL), duck, ORACLES[name]) is None
