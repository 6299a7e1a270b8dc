"""Parsed klines → the four warehouse tables (and the in-flight candle).

All functions are projections or a keyed dedupe, so they work on batch and
streaming input alike.  Stored time columns have second resolution, as the
warehouse's ``DateTime`` columns do; the windowed average works on the
millisecond candle instead.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.symbols import base_asset, quote_asset
from candlewick.functions.time import millis_to_ts, to_seconds
from candlewick.schemas import DEFAULT_ASSET_CLASS, KLINE_DATA, KLINE_EVENTS, SYMBOLS


def _ts(ms_col: str, precision: str) -> Column:
    ts = millis_to_ts(ms_col)
    return to_seconds(ts) if precision == "second" else ts


def to_kline_data(klines: DataFrame, precision: str = "second") -> DataFrame:
    """One row per kline message (closed or not), the 17 columns of ``kline_data``."""
    out = klines.select(
        F.col("k_symbol").alias("symbol"),
        "interval",
        _ts("open_time_ms", precision).alias("open_time"),
        _ts("close_time_ms", precision).alias("close_time"),
        "first_trade_id", "last_trade_id", "open", "close", "high", "low", "volume",
        "trade_count", "is_closed", "quote_asset_volume", "taker_buy_base_volume",
        "taker_buy_quote_volume",
        _ts("event_time_ms", precision).alias("event_time"),
    )
    return out.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in KLINE_DATA.fields])


def to_kline_events(klines: DataFrame, precision: str = "second") -> DataFrame:
    """Event header per kline message: (event_type, event_time, symbol of the message)."""
    out = klines.select("event_type", _ts("event_time_ms", precision).alias("event_time"), "symbol")
    return out.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in KLINE_EVENTS.fields])


def to_candles(klines: DataFrame) -> DataFrame:
    """The compact candle that feeds the windowed average (millisecond times)."""
    return klines.select(
        F.col("k_symbol").alias("symbol"), "open_time_ms", "close_time_ms",
        "open", "close", "high", "low", "volume",
    )


def asset_class(symbol: Column, overrides: dict[str, str] | None = None,
                default: str = DEFAULT_ASSET_CLASS) -> Column:
    expr = F.lit(default)
    for sym, cls in (overrides or {}).items():
        expr = F.when(symbol == sym, F.lit(cls)).otherwise(expr)
    return expr


def to_symbols(klines: DataFrame, launched: dt.date | str | None = None,
               asset_classes: dict[str, str] | None = None, distinct: bool = True) -> DataFrame:
    """First sighting of each symbol → ``symbols`` row.

    ``dropDuplicates`` on the symbol alone, before anything is derived: in batch
    it is a hash aggregate with a map-side partial step (a symbol holding a third
    of all rows is collapsed in every task before the shuffle); on a stream it
    keeps one state entry per symbol forever, like the reference's keyed flag.
    The derived columns depend only on the symbol, so which duplicate survives
    does not matter.  ``launched`` is the processing date unless given.  ``distinct=False``
    takes rows whose symbols are distinct already.
    """
    firsts = klines.select("symbol")
    if distinct:
        firsts = firsts.dropDuplicates(["symbol"])
    s = F.col("symbol")
    day = F.current_date() if launched is None else F.lit(str(launched)).cast("date")
    out = firsts.select(
        s.alias("symbol"), base_asset(s).alias("base_asset"), quote_asset(s).alias("quote_asset"),
        asset_class(s, asset_classes).alias("asset_class"), day.alias("launched"),
    )
    return out.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in SYMBOLS.fields])
