"""Every registered query against its DuckDB oracle on sf0.001 (the driver's check
runs the same comparison on sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from driftwood.plans import ORACLE, QUERIES  # noqa: E402
from conftest import SF_SMALL  # noqa: E402


@pytest.fixture(scope="module")
def con():
    import oracle_check
    return oracle_check.duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    import oracle_check
    line = oracle_check.compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF_SMALL)
    assert line.startswith("OK"), line


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_contract(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(QUERIES) <= set(e.queries())
    assert set(ORACLE) <= set(e.oracle_sql()) <= set(e.queries())
