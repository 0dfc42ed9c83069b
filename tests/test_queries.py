import pytest

import __spark_entry__ as entry
from quern import queries as core
from quern import source_queries
from tests.oracle import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(core.ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert compare(spark, name, core.QUERIES[name], core.ORACLES[name], FOLDER) is None


@pytest.mark.parametrize("name", sorted(set(core.QUERIES) - set(core.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert core.QUERIES[name](spark, FOLDER).count() > 0


def test_source_queries_are_registered():
    assert source_queries.csv_scan is core.QUERIES["csv_scan"]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
