"""Statements over the registered views and functions agree with the DataFrame functions."""

import pytest
from pyspark.sql import functions as F

from candlewick.operators import analytics as A
from candlewick.plans.ingest import fixture_warehouse
from candlewick.plans.sql import plan_text, register_tables
from conftest import SMOKE_DIR


@pytest.fixture(scope="module")
def wh(spark):
    w = fixture_warehouse(spark, SMOKE_DIR)
    register_tables(spark, w)
    return w


IN_RANGE = ("SELECT symbol, count(*) AS n FROM kline_data WHERE month BETWEEN toYYYYMM(toDateTime('{0}')) AND "
            "toYYYYMM(toDateTime('{1}')) AND open_time >= toDateTime('{0}') AND open_time < toDateTime('{1}') GROUP BY symbol")


def test_views_and_functions(spark, wh):
    got = spark.sql(IN_RANGE.format("2024-01-08", "2024-01-15")).agg(F.sum("n")).first()[0]
    assert got == A.count_between(wh.table("kline_data"), "2024-01-08", "2024-01-15").first()[0]


def test_sql_functions_fold_and_prune(spark, wh):
    text = plan_text(spark.sql(IN_RANGE.format("2024-01-08", "2024-01-15")))
    assert "PartitionFilters: [isnotnull(month" in text
    assert "GreaterThanOrEqual(open_time,2024-01-08" in text


def test_explain_of_the_join(spark, wh):
    text = plan_text(A.avg_volume_by_class(wh.table("kline_data"), wh.table("symbols")), "simple")
    assert "Join" in text and "HashAggregate" in text
