"""Plan shape of the analyst queries on the stored fixture tables."""

import pytest

from candlewick.operators import analytics as A
from candlewick.plans.ingest import fixture_warehouse
from conftest import SMOKE_DIR


@pytest.fixture(scope="module")
def wh(spark):
    return fixture_warehouse(spark, SMOKE_DIR)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_q2_aggregates_before_join(wh):
    p = plan(A.avg_volume_by_class(wh.table("kline_data"), wh.table("symbols")))
    # the join sits above the fact aggregate: partial aggregate reads the scan directly
    join_at = p.find("Join")
    agg_at = p.find("HashAggregate")
    assert join_at != -1 and agg_at != -1 and join_at < agg_at
    assert "EqualTo(asset_class,crypto)" in p


def test_q4_prunes_months(wh):
    p = plan(A.count_between(wh.table("kline_data"), "2024-01-08", "2024-01-15"))
    assert "PartitionFilters: [isnotnull(month" in p
    assert "GreaterThanOrEqual(open_time" in p


def _symbol_windows(p):
    return [line for line in p.splitlines() if "Window [" in line and "windowspecdefinition(symbol" in line]


def test_q3_window_runs_per_symbol_chunk(wh):
    # a symbol larger than a chunk: the window runs per (symbol, chunk)
    p = plan(A.moving_average(wh.table("kline_data"), "CLICKUSDT", chunk_rows=50))
    assert "rangepartitioning(symbol" in p
    wins = _symbol_windows(p)
    assert len(wins) == 1 and "_chunk" in wins[0].split("windowspecdefinition(")[1][:60]
    # the window needs no exchange of its own beyond the range partitioning
    assert "hashpartitioning(symbol" not in p


def test_q6_one_window_node(wh):
    p = plan(A.price_delta(wh.table("kline_data"), "CLICKUSDT", chunk_rows=50))
    wins = _symbol_windows(p)
    assert len(wins) == 1 and "lag(close" in wins[0]


@pytest.mark.parametrize("symbol", ["CLICKUSDT", None])
def test_one_window_path_at_every_size(wh, symbol):
    for df in (A.price_delta(wh.table("kline_data"), symbol), A.moving_average(wh.table("kline_data"), symbol)):
        p = plan(df)
        assert "SinglePartition" not in p and "_chunk" in p and "rangepartitioning(symbol" in p


def test_filter_first_drops_fact_rows_before_the_aggregate(wh, spark):
    orders = spark.read.parquet(f"{SMOKE_DIR}/orders.parquet")
    customer = spark.read.parquet(f"{SMOKE_DIR}/customer.parquet").where("c_mktsegment = 'BUILDING'")
    args = (orders, customer, "o_custkey", "c_custkey", "o_totalprice", "a")
    p = plan(A.avg_for_members(*args, filter_first=True))
    assert "LeftSemi" in p and p.find("HashAggregate") < p.find("LeftSemi")
    assert sorted((r[0], round(r[1], 6)) for r in A.avg_for_members(*args, filter_first=True).collect()) == sorted(
        (r[0], round(r[1], 6)) for r in A.avg_for_members(*args).collect())


def test_no_python_udf_in_batch_plans(wh):
    dfs = [A.avg_volume_by_class(wh.table("kline_data"), wh.table("symbols")),
           A.moving_average(wh.table("kline_data"), "CLICKUSDT"),
           A.events_in_candles(wh.table("kline_events"), wh.table("kline_data")),
           A.price_delta(wh.table("kline_data"), "CLICKUSDT")]
    for df in dfs:
        p = plan(df)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p
