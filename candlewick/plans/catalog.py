"""The registered queries: name → (spark, sf_dir) → DataFrame.

Every query reads ``{sf_dir}/events.parquet`` (rendered as raw exchange
messages, see ``sources.fixtures``) or the star-schema tables, so its work grows
with the input.  Ingest queries parse the messages directly; analyst queries
read the stored warehouse built from them (month-partitioned, sorted Parquet).
Averages are rounded to 6 decimals here and in the oracle, so the check does not
depend on summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.symbols import base_asset, quote_asset
from candlewick.operators import analytics as A
from candlewick.operators.parse import kline_rejects, parse_klines, trade_headers, typed_trades
from candlewick.operators.tables import to_candles, to_kline_data, to_kline_events, to_symbols
from candlewick.operators.windows import avg_close
from candlewick.plans.ingest import FIXTURE_LAUNCHED, fixture_warehouse
from candlewick.functions.time import yyyymm
from candlewick.session import configure, scratch_path
from candlewick.sources.fixtures import (
    ASSET_CLASS_OVERRIDES, corrupted_messages, faulty_messages, fixture_messages, read_events,
)
from candlewick.streaming.relay import balanced, relay_records

# Parameters of the analyst queries on the fixture (fixed values).
FOCUS_SYMBOL = "CLICKUSDT"
RANGE_LO, RANGE_HI = "2024-01-08", "2024-01-15"
ASSET_CLASS = "crypto"
SEGMENT = "BUILDING"
ORDERS_LO, ORDERS_HI = "1996-01-01", "1997-01-01"
DIGITS = 6
RELAY_PARTS = 7
# Chunk size of the "_chunked" variants: small enough that the focus symbol spans
# several chunks from sf0.01 up.
CHECK_CHUNK_ROWS = 1000

Query = Callable[[SparkSession, str], DataFrame]


def _klines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_klines(fixture_messages(configure(spark), sf_dir))


def _tables(spark: SparkSession, sf_dir: str):
    return fixture_warehouse(configure(spark), sf_dir)


def _round(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in cols})


# -- ingest: messages → rows -------------------------------------------------

def q_kline_messages(spark, sf_dir):
    return _klines(spark, sf_dir).select(F.col("first_trade_id").alias("event_id"))


def q_kline_data(spark, sf_dir):
    return to_kline_data(_klines(spark, sf_dir))


def q_kline_events(spark, sf_dir):
    return to_kline_events(_klines(spark, sf_dir))


def q_trade_events(spark, sf_dir):
    return typed_trades(fixture_messages(configure(spark), sf_dir))


def q_trade_headers(spark, sf_dir):
    return trade_headers(fixture_messages(configure(spark), sf_dir))


def q_candles(spark, sf_dir):
    return to_candles(_klines(spark, sf_dir))


def q_symbols(spark, sf_dir):
    return to_symbols(_klines(spark, sf_dir), FIXTURE_LAUNCHED, ASSET_CLASS_OVERRIDES)


def q_symbol_parts(spark, sf_dir):
    s = F.col("symbol")
    return to_kline_events(_klines(spark, sf_dir)).select(
        s, base_asset(s).alias("base_asset"), quote_asset(s).alias("quote_asset"))


def q_kline_permissive(spark, sf_dir):
    """Permissive parse of messages with some corrupted close prices: the good rows."""
    msgs = corrupted_messages(fixture_messages(configure(spark), sf_dir))
    return parse_klines(msgs, "permissive").select(F.col("first_trade_id").alias("event_id"))


def q_kline_rejects(spark, sf_dir):
    """… and the rejected messages (their event ids)."""
    msgs = corrupted_messages(fixture_messages(configure(spark), sf_dir))
    return kline_rejects(msgs).select(F.get_json_object("value", "$.k.f").cast("bigint").alias("event_id"))


def q_relay(spark, sf_dir):
    return relay_records(fixture_messages(configure(spark), sf_dir))


def q_relay_faults(spark, sf_dir):
    """The relay of messages among which some are empty, cut, arrays, or have text behind them."""
    return relay_records(faulty_messages(read_events(configure(spark), sf_dir)))


def q_relay_balanced(spark, sf_dir):
    """The relay spread by bytes over RELAY_PARTS parts; ``even``: no part differs from the mean by over a tenth."""
    parts = balanced(relay_records(fixture_messages(configure(spark), sf_dir)), RELAY_PARTS)
    sizes = parts.groupBy(F.spark_partition_id().alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value").cast("long")).alias("bytes"))
    return sizes.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("parts"),
                     (F.max("bytes") <= F.avg("bytes") * 1.1).alias("even"))


def q_avg_close_hourly(spark, sf_dir):
    return _round(avg_close(to_candles(_klines(spark, sf_dir)), "1 hour"), "avg_close")


# -- analyst queries over the stored tables ---------------------------------

def q_avg_close(spark, sf_dir):
    return _round(A.all_windowed_averages(_tables(spark, sf_dir).table("kline_agg")), "avg_close")


def q_avg_volume_crypto(spark, sf_dir):
    wh = _tables(spark, sf_dir)
    return _round(A.avg_volume_by_class(wh.table("kline_data"), wh.table("symbols"), ASSET_CLASS), "avg_volume")


def q_moving_average_5(spark, sf_dir):
    return _round(A.moving_average(_tables(spark, sf_dir).table("kline_data"), FOCUS_SYMBOL, 5), "ma5")


def q_moving_average_5_chunked(spark, sf_dir):
    kd = _tables(spark, sf_dir).table("kline_data")
    return _round(A.moving_average(kd, FOCUS_SYMBOL, 5, chunk_rows=CHECK_CHUNK_ROWS), "ma5")


def q_price_delta_chunked(spark, sf_dir):
    return A.price_delta(_tables(spark, sf_dir).table("kline_data"), FOCUS_SYMBOL, chunk_rows=CHECK_CHUNK_ROWS)


def q_moving_average_5_all(spark, sf_dir):
    """Every symbol, not only the focus one."""
    return _round(A.moving_average(_tables(spark, sf_dir).table("kline_data"), None, 5), "ma5")


def q_price_delta_all(spark, sf_dir):
    return A.price_delta(_tables(spark, sf_dir).table("kline_data"))


def q_count_between(spark, sf_dir):
    return A.count_between(_tables(spark, sf_dir).table("kline_data"), RANGE_LO, RANGE_HI)


def q_events_in_candles(spark, sf_dir):
    wh = _tables(spark, sf_dir)
    return A.events_in_candles(wh.table("kline_events"), wh.table("kline_data"))


def q_price_delta(spark, sf_dir):
    return A.price_delta(_tables(spark, sf_dir).table("kline_data"), FOCUS_SYMBOL)


def q_monthly_layout(spark, sf_dir):
    kd = _tables(spark, sf_dir).table("kline_data")
    return kd.groupBy("month").agg(F.count(F.lit(1)).alias("n"))


# -- the same operators on the star schema ----------------------------------

def q_orders_by_segment(spark, sf_dir):
    """JN1 + AGG2 shape on orders ⋈ customer: many keys with few rows each, so the fact is filtered first."""
    configure(spark)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    wanted = customer.where(F.col("c_mktsegment") == F.lit(SEGMENT))
    out = A.avg_for_members(orders, wanted, "o_custkey", "c_custkey", "o_totalprice", "avg_totalprice",
                            filter_first=True)
    return _round(out, "avg_totalprice")


def q_orders_between(spark, sf_dir):
    """FLT6 + AGG3 on orders."""
    configure(spark)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return A.count_between(orders, ORDERS_LO, ORDERS_HI, time_col="o_orderdate")


_MONTHLY: dict[tuple[str, str], str] = {}


def _orders_by_month(spark, sf_dir):
    """``orders`` stored by month of the order date, once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _MONTHLY:
        path = scratch_path(configure(spark), "orders-by-month")
        orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("month", yyyymm("o_orderdate"))
        (orders.hint("rebalance", "month").sortWithinPartitions("month", "o_orderdate")
         .write.partitionBy("month").parquet(path))
        _MONTHLY[key] = path
    return spark.read.parquet(_MONTHLY[key])


def q_orders_between_pruned(spark, sf_dir):
    """FLT6 on a table of many months: the month predicate leaves those of one year."""
    return A.count_between(_orders_by_month(spark, sf_dir), ORDERS_LO, ORDERS_HI, time_col="o_orderdate")


def q_orders_monthly_layout(spark, sf_dir):
    """SNK10 on a table of many months."""
    return _orders_by_month(spark, sf_dir).groupBy("month").agg(F.count(F.lit(1)).alias("n"))


QUERIES: dict[str, Query] = {
    "kline_messages": q_kline_messages,
    "kline_data": q_kline_data,
    "kline_events": q_kline_events,
    "trade_events": q_trade_events,
    "trade_headers": q_trade_headers,
    "candles": q_candles,
    "symbols": q_symbols,
    "symbol_parts": q_symbol_parts,
    "kline_permissive": q_kline_permissive,
    "kline_rejects": q_kline_rejects,
    "relay": q_relay,
    "relay_faults": q_relay_faults,
    "relay_balanced": q_relay_balanced,
    "avg_close": q_avg_close,
    "avg_close_hourly": q_avg_close_hourly,
    "avg_volume_crypto": q_avg_volume_crypto,
    "moving_average_5": q_moving_average_5,
    "moving_average_5_chunked": q_moving_average_5_chunked,
    "moving_average_5_all": q_moving_average_5_all,
    "price_delta_all": q_price_delta_all,
    "count_between": q_count_between,
    "events_in_candles": q_events_in_candles,
    "price_delta": q_price_delta,
    "price_delta_chunked": q_price_delta_chunked,
    "monthly_layout": q_monthly_layout,
    "orders_by_segment": q_orders_by_segment,
    "orders_between": q_orders_between,
    "orders_between_pruned": q_orders_between_pruned,
    "orders_monthly_layout": q_orders_monthly_layout,
}


def all_queries() -> dict[str, Query]:
    from candlewick.plans.streams import STREAM_QUERIES
    return {**QUERIES, **STREAM_QUERIES}
