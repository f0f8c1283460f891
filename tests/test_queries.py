"""Every registered query beside its SQL."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, folder, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], folder) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row.avg_polygons > 0
