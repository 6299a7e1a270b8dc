"""candlewick: candlestick stream and warehouse analytics on Spark DataFrames.

The main entry points, re-exported:

* parsing and tables: ``parse_klines``, ``parse_trades``, ``kline_rejects``, ``to_kline_data``,
  ``to_kline_events``, ``to_symbols``, ``to_candles``, ``avg_close``;
* analyst queries: ``avg_volume_by_class``, ``moving_average``, ``count_between``,
  ``events_in_candles``, ``price_delta``, ``all_windowed_averages``;
* storage: ``Warehouse``, ``write_table``, ``read_table``, ``time_range``;
* streaming: ``start_fanout``, ``start_kline_agg``, ``start_symbols``, ``relay_records``;
* session: ``configure``, ``get_session``, ``scale_conf``.
"""

from candlewick.functions.time import time_range
from candlewick.operators.analytics import (
    all_windowed_averages, avg_volume_by_class, count_between, events_in_candles, moving_average, price_delta,
)
from candlewick.operators.parse import kline_rejects, parse_klines, parse_trades
from candlewick.operators.tables import to_candles, to_kline_data, to_kline_events, to_symbols
from candlewick.operators.windows import avg_close
from candlewick.session import configure, get_session, scale_conf
from candlewick.sources.warehouse import Warehouse, read_table, write_table
from candlewick.streaming.aggregate import start_kline_agg
from candlewick.streaming.dedupe import start_symbols
from candlewick.streaming.fanout import start_fanout
from candlewick.streaming.relay import relay_records

__version__ = "0.1.0"

__all__ = [
    "time_range", "all_windowed_averages", "avg_volume_by_class", "count_between", "events_in_candles",
    "moving_average", "price_delta", "kline_rejects", "parse_klines", "parse_trades", "to_candles",
    "to_kline_data", "to_kline_events", "to_symbols", "avg_close", "configure", "get_session", "scale_conf",
    "Warehouse", "read_table", "write_table", "start_kline_agg", "start_symbols", "start_fanout",
    "relay_records",
]
