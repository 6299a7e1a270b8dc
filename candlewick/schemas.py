"""Schemas, fixed values and the stored-table layout.

Every schema is declared by hand; nothing is inferred.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Quote assets recognised as a symbol suffix, in the reference's order:
KNOWN_QUOTES = ("USDT", "BUSD", "BTC", "ETH", "BNB", "TRY", "TUSD", "USDC")
# Quote asset given to a symbol with none of the suffixes above:
UNKNOWN_QUOTE = "UNKNOWN"
# Asset class written for every symbol:
DEFAULT_ASSET_CLASS = "crypto"
# Message prefilters (whitespace-sensitive substrings):
KLINE_MARKER = '"e":"kline"'
TRADE_MARKER = '"e":"trade"'
# Window of the streaming average and its allowed disorder:
AGG_WINDOW = "1 minute"
AGG_WATERMARK_DELAY = "0 seconds"
# ---------------------------------------------------------------------------

RAW_MESSAGE = T.StructType([T.StructField("value", T.StringType(), True)])

# The columns and types of the four tables are fixed values too (the stored contract).
KLINE_DATA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("interval", T.StringType()),
    T.StructField("open_time", T.TimestampType()),
    T.StructField("close_time", T.TimestampType()),
    T.StructField("first_trade_id", T.LongType()),
    T.StructField("last_trade_id", T.LongType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("trade_count", T.IntegerType()),
    T.StructField("is_closed", T.BooleanType()),
    T.StructField("quote_asset_volume", T.DoubleType()),
    T.StructField("taker_buy_base_volume", T.DoubleType()),
    T.StructField("taker_buy_quote_volume", T.DoubleType()),
    T.StructField("event_time", T.TimestampType()),
])

KLINE_EVENTS = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("symbol", T.StringType()),
])

SYMBOLS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("base_asset", T.StringType()),
    T.StructField("quote_asset", T.StringType()),
    T.StructField("asset_class", T.StringType()),
    T.StructField("launched", T.DateType()),
])

KLINE_AGG = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("avg_close", T.DoubleType()),
])

# How ``kline_agg`` is stored: the parts of each window's average, one row for each load (or
# more) that saw some of its updates.  Readers add them up.
KLINE_AGG_PARTS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("close_sum", T.DoubleType()),
    T.StructField("close_count", T.LongType()),
])

# Candle updates that came after their window was closed.
KLINE_LATE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("close_time", T.TimestampType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("close", T.DoubleType()),
])

# The compact in-flight candle that feeds the windowed average (times in ms).
CANDLES = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("open_time_ms", T.LongType()),
    T.StructField("close_time_ms", T.LongType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
])

TRADES = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("trade_id", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("trade_time", T.TimestampType()),
    T.StructField("buyer_is_maker", T.BooleanType()),
    T.StructField("ignore_flag", T.BooleanType()),
])


@dataclass(frozen=True)
class TableLayout:
    """How a table is stored: schema, month partition source column, sort key."""

    name: str
    schema: T.StructType
    sort_by: tuple[str, ...]
    month_of: str | None = None   # column whose yyyymm becomes the ``month`` partition
    parts: T.StructType | None = None   # stored instead of ``schema``: parts of rows that readers merge

    @property
    def partition_by(self) -> tuple[str, ...]:
        return ("month",) if self.month_of else ()

    @property
    def range_of(self) -> tuple[str, ...]:
        """Key and time column whose ranges choose files; empty for a table without a time."""
        return (self.sort_by[0], self.month_of or self.sort_by[-1]) if len(self.sort_by) > 1 else ()

    @property
    def stored(self) -> T.StructType:
        return self.parts or self.schema


LAYOUTS = {
    "kline_agg": TableLayout("kline_agg", KLINE_AGG, ("symbol", "window_start"), parts=KLINE_AGG_PARTS),
    "kline_events": TableLayout("kline_events", KLINE_EVENTS, ("symbol", "event_time"), "event_time"),
    "kline_data": TableLayout("kline_data", KLINE_DATA, ("symbol", "interval", "open_time"), "open_time"),
    "symbols": TableLayout("symbols", SYMBOLS, ("symbol",)),
    "kline_late": TableLayout("kline_late", KLINE_LATE, ("symbol", "close_time"), "close_time"),
}
