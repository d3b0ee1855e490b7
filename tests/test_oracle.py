"""Every registered query against its DuckDB oracle on the smallest fixture
(the driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as E
from dockyard.plans import registry
from tests.conftest import SF_SMALL
from tests.oracle_check import _key, duck, rows_of_duck, rows_of_spark

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sc, sr = rows_of_spark(QUERIES[name](spark, SF_SMALL))
    dc, dr = rows_of_duck(con, ORACLE[name])
    assert sc == dc
    assert sorted(sr, key=_key) == sorted(dr, key=_key)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "uom_qty" in df.columns
