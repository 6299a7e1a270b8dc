"""Column-expression helpers (all JVM-side, no Python UDFs)."""

from candlewick.functions.symbols import base_asset, parse_symbol, quote_asset
from candlewick.functions.time import millis_to_ts, month_key, time_range, to_seconds, ts_to_millis, yyyymm

__all__ = [
    "base_asset", "parse_symbol", "quote_asset",
    "millis_to_ts", "month_key", "time_range", "to_seconds", "ts_to_millis", "yyyymm",
]
