"""The analyst queries over the stored tables (batch).

Each function takes the tables as DataFrames and returns a DataFrame; the
comments say why the plan is shaped the way it is for large inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.time import time_range
from candlewick.operators.joins import range_join_bucketed
from candlewick.operators.sequence import DEFAULT_CHUNK_ROWS, chunked_window

# Tie-breakers after open_time: several updates share one candle's open time.
TIE_BREAK = ("event_time", "first_trade_id", "last_trade_id")


def all_windowed_averages(kline_agg: DataFrame) -> DataFrame:
    """Q1: ``SELECT * FROM kline_agg`` (column-pruned scan)."""
    return kline_agg.select("symbol", "window_start", "avg_close")


def avg_volume_by_class(kline_data: DataFrame, symbols: DataFrame, asset_class: str = "crypto") -> DataFrame:
    """Q2: average volume per symbol of one asset class.

    Written as the reference's join-then-group would compute it, but aggregated
    first: the fact table is reduced to one row per symbol by a partial
    (map-side) and a final aggregate before it meets the dimension, so the
    shuffle carries a few rows per symbol per task instead of every row, and a
    hot symbol costs nothing extra.  The dimension side is de-duplicated on the
    key, so the inner join keeps one row per symbol (with duplicates the
    reference's join would only repeat rows, which leaves an average unchanged).
    An inner join rather than a semi join: the optimizer would push a semi join
    below the aggregate, and if the dimension were too big to broadcast that
    would shuffle every fact row.  No broadcast hint: both sides are one row per
    symbol, and Spark broadcasts only below its size threshold (static file
    size, or the measured shuffle size under AQE).
    """
    return avg_for_members(kline_data, symbols.where(F.col("asset_class") == F.lit(asset_class)),
                           "symbol", "symbol", "volume", "avg_volume")


def avg_for_members(fact: DataFrame, members: DataFrame, fact_key: str, member_key: str,
                    value: str, out_name: str, filter_first: bool = False) -> DataFrame:
    """``SELECT f.key, avg(f.value) FROM fact f JOIN members m ON f.key = m.key GROUP BY f.key``.

    By default aggregated before the join (see ``avg_volume_by_class``): right for few
    keys with many rows each.  ``filter_first=True`` drops the rows of other keys before
    the aggregate: right for many keys with few rows each, where a partial aggregate
    reduces little and most rows would be shuffled only to be dropped.  A semi join,
    so repeated members don't repeat rows.
    """
    if filter_first:
        wanted = members.select(F.col(member_key).alias("_member"))
        kept = fact.join(wanted, F.col(fact_key) == F.col("_member"), "left_semi")
        return kept.groupBy(fact_key).agg(F.avg(value).alias(out_name))
    per_key = fact.groupBy(fact_key).agg(F.avg(value).alias(out_name))
    wanted = members.select(F.col(member_key).alias(fact_key)).dropDuplicates([fact_key])
    return per_key.join(wanted, fact_key, "inner").select(fact_key, out_name)


def moving_average(kline_data: DataFrame, symbol: str | None = None, rows: int = 5,
                   chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Q3: ``avg(close) OVER (PARTITION BY symbol ORDER BY open_time ROWS BETWEEN rows-1 PRECEDING AND CURRENT ROW)``.

    The symbol filter is pushed into the Parquet scan.  The window itself runs
    on bounded chunks (see ``sequence.chunked_window``), never one task per symbol.
    Output ordered by (symbol, open_time, tie-breakers).
    """
    df = kline_data
    if symbol is not None:
        df = df.where(F.col("symbol") == F.lit(symbol))
    df = df.select("symbol", "open_time", "close", *TIE_BREAK)
    out = chunked_window(
        df, ["symbol"], ["open_time", *TIE_BREAK], rows - 1,
        lambda w: {"ma": F.avg("close").over(w.rowsBetween(-(rows - 1), 0))},
        chunk_rows=chunk_rows,
    )
    return out.select("symbol", "open_time", "close", F.col("ma").alias(f"ma{rows}"))


def count_between(kline_data: DataFrame, lo, hi, time_col: str = "open_time") -> DataFrame:
    """Q4: rows with ``lo <= open_time < hi``.

    When the table carries the ``month`` partition column, the month predicate
    derived from the bounds prunes whole partitions; the exact bound is applied
    to the rest (and pushed to Parquet row groups, which the sort order makes
    selective).
    """
    month = "month" if "month" in kline_data.columns else None
    return kline_data.where(time_range(time_col, lo, hi, month)).agg(F.count(F.lit(1)).alias("n"))


def events_in_candles(kline_events: DataFrame, kline_data: DataFrame, event_type: str = "kline") -> DataFrame:
    """Q5: each event joined with every candle row of the same symbol containing it.

    A time-bucket equi-key is added; events are copied only to the bucket levels the
    candles occupy, the pairs of a hot bucket are spread over as many tasks as it needs, and
    the updates of a candle meet an event as lists.
    """
    ev = kline_events.where(F.col("event_type") == F.lit(event_type)).select("symbol", "event_time")
    cd = kline_data.select("symbol", "open_time", "close_time", "close")
    j = range_join_bucketed(ev, cd)
    return j.select(F.col("e.symbol").alias("symbol"), F.col("e.event_time").alias("event_time"),
                    F.col("c.open_time").alias("open_time"), F.col("c.close").alias("close"))


def price_delta(kline_data: DataFrame, symbol: str | None = None,
                chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Q6: previous close and the change to it, per symbol in open_time order.

    Both ``lag`` columns share one window (one pass); the first row of a symbol
    has NULL for both.
    """
    df = kline_data
    if symbol is not None:
        df = df.where(F.col("symbol") == F.lit(symbol))
    df = df.select("symbol", "open_time", "close", *TIE_BREAK)
    out = chunked_window(
        df, ["symbol"], ["open_time", *TIE_BREAK], 1,
        lambda w: {"prev_close": F.lag("close", 1).over(w)},
        chunk_rows=chunk_rows,
    )
    return out.select("symbol", "open_time", "close", "prev_close",
                      (F.col("close") - F.col("prev_close")).alias("price_delta"))
