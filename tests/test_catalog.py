"""Every registered query against its DuckDB oracle on the smallest fixture."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from candlewick.plans.catalog import all_queries  # noqa: E402
from candlewick.plans.oracle import ORACLE  # noqa: E402
from conftest import SMOKE_DIR  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

QUERIES = all_queries()


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, ns, nd, _, detail, _ = compare(spark, con, name, QUERIES[name], ORACLE[name], SMOKE_DIR)
    assert ok, detail
    assert ns > 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["symbol", "avg_volume"]
    assert df.count() == 4
