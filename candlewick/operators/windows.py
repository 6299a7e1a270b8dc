"""Event-time tumbling-window average of the close price (``kline_agg``).

One definition for batch and streaming: on a stream the watermark decides when a
window is final and append mode emits it once; on a batch ``withWatermark`` is a
no-op and every window is final.  The average is kept as its accumulator, sum and
count, which Spark adds up per task first and then after the shuffle on (window,
symbol); a hot symbol costs one partial row per task.  Stored as such, accumulators of
a window that is split between loads still add up to one average (``merge_parts``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.time import millis_to_ts
from candlewick.schemas import AGG_WATERMARK_DELAY, AGG_WINDOW


def avg_close(candles: DataFrame, window: str = AGG_WINDOW, delay: str = AGG_WATERMARK_DELAY,
              time_col: str = "close_time_ms", closed_only: bool = False) -> DataFrame:
    """(symbol, window_start, avg_close) per event-time window of ``time_col``.

    The event time is the candle's close time, as in the reference; a 1-minute
    candle (close = open + 59.999 s) falls in the window that starts at its open.
    ``closed_only`` keeps only final candle updates (the reference averages all);
    it needs ``is_closed``, i.e. parsed klines or ``kline_data`` as input.
    """
    parts = close_parts(candles, window, delay, time_col, closed_only)
    return parts.select("symbol", "window_start", average())


def average() -> Column:
    """``avg_close`` of summed parts."""
    return F.try_divide("close_sum", F.col("close_count").cast("double")).alias("avg_close")


def merge_parts(parts: DataFrame) -> DataFrame:
    """One row for each window: the parts of its average added up (partial sums in every task first)."""
    return parts.groupBy("symbol", "window_start").agg(F.sum("close_sum").alias("close_sum"),
                                                       F.sum("close_count").alias("close_count"))


def close_parts(candles: DataFrame, window: str = AGG_WINDOW, delay: str = AGG_WATERMARK_DELAY,
                time_col: str = "close_time_ms", closed_only: bool = False) -> DataFrame:
    """(symbol, window_start, close_sum, close_count): the accumulator of the average, per window.

    Accumulators of the same window from different loads merge by addition.
    """
    df = candles
    if closed_only:
        if "is_closed" not in df.columns:
            raise ValueError("closed_only needs an is_closed column (parsed klines or kline_data, not candles)")
        df = df.where(F.col("is_closed"))
    ts = F.col(time_col)
    if isinstance(df.schema[time_col].dataType, (T.LongType, T.IntegerType)):
        ts = millis_to_ts(ts)
    df = df.select("symbol", "close", ts.alias("_event_ts"))
    if df.isStreaming:
        df = df.withWatermark("_event_ts", delay)
    agg = df.groupBy(F.window("_event_ts", window).alias("_w"), "symbol").agg(
        F.sum("close").alias("close_sum"), F.count("close").alias("close_count"))
    return agg.select("symbol", F.col("_w.start").alias("window_start"), "close_sum", "close_count")
