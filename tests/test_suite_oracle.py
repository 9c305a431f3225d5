"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from helpers import SF_SMALL
from nimbusframe.plans.suite import ORACLE, QUERIES
from oracle_check import compare, duck

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["issue", "count"] and df.count() == 7


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, n, _sec, detail = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert ok, detail
