"""DuckDB SQL for every catalogue entry, straight from the driver's tables.

The views of FIXTURES.md §5 are inlined as CTEs: the fixture mapping written in
SQL (no JSON round trip), so the oracle shares nothing with the Spark side but
the fixed values.
"""

from __future__ import annotations

from candlewick.plans.catalog import (
    ASSET_CLASS, DIGITS, FOCUS_SYMBOL, ORDERS_HI, ORDERS_LO, RANGE_HI, RANGE_LO, RELAY_PARTS, SEGMENT,
)
from candlewick.plans.ingest import FIXTURE_LAUNCHED
from candlewick.schemas import DEFAULT_ASSET_CLASS, KNOWN_QUOTES, UNKNOWN_QUOTE
from candlewick.sources.fixtures import (
    ASSET_CLASS_OVERRIDES, CONTROL_TEMPLATE, CORRUPT_MODULUS, EVENT_SYMBOLS, FAULT_MODULUS, FAULTS, KLINE_TEMPLATE,
    OTHER_SYMBOL, TRADE_TEMPLATE,
)


def _case_symbol() -> str:
    whens = " ".join(f"when '{k}' then '{v}'" for k, v in EVENT_SYMBOLS.items())
    return f"case event_type {whens} else '{OTHER_SYMBOL}' end"


def _quote_case(col: str) -> str:
    whens = " ".join(f"when ends_with({col}, '{q}') then '{q}'" for q in KNOWN_QUOTES)
    return f"case {whens} else '{UNKNOWN_QUOTE}' end"


def _base_case(col: str) -> str:
    whens = " ".join(f"when ends_with({col}, '{q}') then left({col}, length({col}) - {len(q)})" for q in KNOWN_QUOTES)
    return f"case {whens} else {col} end"


def _class_case(col: str) -> str:
    whens = " ".join(f"when {col} = '{s}' then '{c}'" for s, c in ASSET_CLASS_OVERRIDES.items())
    return f"case {whens} else '{DEFAULT_ASSET_CLASS}' end"


CTES = f"""
ev as (select *, epoch_us(ts) // 1000 as ems, epoch_ms(date_trunc('hour', ts)) as hms,
  {_case_symbol()} as sym,
  cast(json_extract(props, '$.k') as integer) as kk from events),
kline_data as (select sym as symbol, '1h' as "interval", date_trunc('hour', ts) as open_time,
  date_trunc('hour', ts) + interval 3599 second as close_time, event_id as first_trade_id, event_id + kk as last_trade_id,
  value as "open", value as "close", floor(value) + 1 as high, floor(value) as low, cast(user_id as double) as volume,
  kk as trade_count, event_id % 10 = 0 as is_closed, cast(user_id * 2 as double) as quote_asset_volume,
  user_id / 2.0::double as taker_buy_base_volume, cast(user_id as double) as taker_buy_quote_volume,
  date_trunc('second', ts) as event_time, hms as open_ms, hms + 3599999 as close_ms
  from ev where event_id % 50 not in (0, 1)),
kline_events as (select 'kline' as event_type, event_time, symbol from kline_data),
symbols as (select symbol, {_base_case('symbol')} as base_asset, {_quote_case('symbol')} as quote_asset,
  {_class_case('symbol')} as asset_class, date '{FIXTURE_LAUNCHED.isoformat()}' as launched
  from (select distinct symbol from kline_events))
"""

KD_COLS = ('symbol, "interval", open_time, close_time, first_trade_id, last_trade_id, "open", "close", high, low, '
           'volume, trade_count, is_closed, quote_asset_volume, taker_buy_base_volume, taker_buy_quote_volume, event_time')

_ORDER = "order by open_time, event_time, first_trade_id, last_trade_id"


def _sql(body: str) -> str:
    return f"with {CTES.strip()}\n{body.strip()}"


def _printf(template: str, args: str) -> str:
    return f"printf('{template}', {args})"


_KLINE_MSG = _printf(KLINE_TEMPLATE, (
    "ems, sym, hms, hms + 3599999, sym, '1h', event_id, event_id + kk, value, value, floor(value) + 1, floor(value), "
    "cast(user_id as double), kk, case when event_id % 10 = 0 then 'true' else 'false' end, "
    "cast(user_id * 2 as double), user_id / 2.0::double, cast(user_id as double)"))
_TRADE_MSG = _printf(TRADE_TEMPLATE, "ems, sym, event_id, value, cast(user_id as double), ems")
_CONTROL_MSG = _printf(CONTROL_TEMPLATE, "event_id")

ORACLE: dict[str, str] = {
    "kline_messages": _sql("select first_trade_id as event_id from kline_data"),
    "kline_data": _sql(f"select {KD_COLS} from kline_data"),
    "kline_events": _sql("select event_type, event_time, symbol from kline_events"),
    "trade_events": _sql("""
        select 'trade' as event_type, make_timestamp(ems * 1000) as event_time, sym as symbol,
          event_id as trade_id, value as price, cast(user_id as double) as quantity,
          make_timestamp(ems * 1000) as trade_time, true as buyer_is_maker, true as ignore_flag
        from ev where event_id % 50 = 1"""),
    "trade_headers": _sql("""
        select 'trade' as event_type, make_timestamp(ems * 1000) as event_time, sym as symbol
        from ev where event_id % 50 = 1"""),
    "candles": _sql("""
        select symbol, open_ms as open_time_ms, close_ms as close_time_ms, "open", "close", high, low, volume
        from kline_data"""),
    "symbols": _sql("select symbol, base_asset, quote_asset, asset_class, launched from symbols"),
    "symbol_parts": _sql(f"""
        select symbol, {_base_case('symbol')} as base_asset, {_quote_case('symbol')} as quote_asset
        from kline_events"""),
    "relay": _sql(f"""
        select case when event_id % 50 = 0 then null else sym end as key,
          case when event_id % 50 = 0 then {_CONTROL_MSG} when event_id % 50 = 1 then {_TRADE_MSG}
               else {_KLINE_MSG} end as value
        from ev"""),
    "avg_close": _sql(f"""
        select symbol, date_trunc('minute', make_timestamp(close_ms * 1000)) as window_start,
          round(avg("close"), {DIGITS}) as avg_close
        from kline_data group by all"""),
    "avg_close_hourly": _sql(f"""
        select symbol, date_trunc('hour', make_timestamp(close_ms * 1000)) as window_start,
          round(avg("close"), {DIGITS}) as avg_close
        from kline_data group by all"""),
    "avg_volume_crypto": _sql(f"""
        select symbol, round(avg(volume), {DIGITS}) as avg_volume from kline_data
        where symbol in (select symbol from symbols where asset_class = '{ASSET_CLASS}')
        group by symbol"""),
    "moving_average_5": _sql(f"""
        select symbol, open_time, "close",
          round(avg("close") over (partition by symbol {_ORDER} rows between 4 preceding and current row), {DIGITS}) as ma5
        from kline_data where symbol = '{FOCUS_SYMBOL}'
        order by open_time, event_time, first_trade_id, last_trade_id"""),
    "count_between": _sql(f"""
        select count(*) as n from kline_data
        where open_time >= timestamp '{RANGE_LO}' and open_time < timestamp '{RANGE_HI}'"""),
    "events_in_candles": _sql("""
        select symbol, happened.event_time, candle.open_time, candle."close"
        from (select symbol, event_time from kline_events where event_type = 'kline') happened
        join (select symbol, open_time, close_time, "close" from kline_data) candle using (symbol)
        where happened.event_time >= candle.open_time and happened.event_time < candle.close_time"""),
    "price_delta": _sql(f"""
        select symbol, open_time, "close",
          lag("close", 1) over (partition by symbol {_ORDER}) as prev_close,
          "close" - lag("close", 1) over (partition by symbol {_ORDER}) as price_delta
        from kline_data where symbol = '{FOCUS_SYMBOL}'
        order by open_time, event_time, first_trade_id, last_trade_id"""),
    "monthly_layout": _sql("""
        select cast(year(open_time) * 100 + month(open_time) as integer) as month, count(*) as n
        from kline_data group by 1"""),
    "orders_by_segment": f"""
        select o.o_custkey, round(avg(o.o_totalprice), {DIGITS}) as avg_totalprice
        from orders o join customer c on o.o_custkey = c.c_custkey
        where c.c_mktsegment = '{SEGMENT}'
        group by o.o_custkey""".strip(),
    "orders_between": f"""
        select count(*) as n from orders
        where o_orderdate >= timestamp '{ORDERS_LO}' and o_orderdate < timestamp '{ORDERS_HI}'""".strip(),
}

_WITHHELD = "window_start + interval 1 minute <= (select make_timestamp(max(close_ms) * 1000) from kline_data)"

ORACLE.update({
    "stream_avg_close": _sql(f"""
        select symbol, window_start, avg_close from (
          select symbol, date_trunc('minute', make_timestamp(close_ms * 1000)) as window_start,
            round(avg("close"), {DIGITS}) as avg_close
          from kline_data group by all)
        where {_WITHHELD}"""),
    "stream_symbols": ORACLE["symbols"],
    "stream_symbols_state": ORACLE["symbols"],
    "moving_average_5_chunked": ORACLE["moving_average_5"],
    "price_delta_chunked": ORACLE["price_delta"],
    "moving_average_5_all": _sql(f"""
        select symbol, open_time, "close",
          round(avg("close") over (partition by symbol {_ORDER} rows between 4 preceding and current row), {DIGITS}) as ma5
        from kline_data"""),
    "price_delta_all": _sql(f"""
        select symbol, open_time, "close",
          lag("close", 1) over (partition by symbol {_ORDER}) as prev_close,
          "close" - lag("close", 1) over (partition by symbol {_ORDER}) as price_delta
        from kline_data"""),
    "stream_fanout": _sql(f"""
        select 'kline_data' as table_name, count(*) as n from kline_data
        union all select 'kline_events', count(*) from kline_events
        union all select 'symbols', count(*) from symbols
        union all select 'kline_agg', count(*) from (
          select symbol, date_trunc('minute', make_timestamp(close_ms * 1000)) as window_start
          from kline_data group by all) where {_WITHHELD}"""),
    "stream_relay": ORACLE["relay"],
    "compact_after_backfill": ORACLE["kline_data"],
    "stream_symbols_restart": ORACLE["symbols"],
    "stream_kline_data": ORACLE["kline_data"],
    "kline_permissive": _sql(f"select first_trade_id as event_id from kline_data where first_trade_id % {CORRUPT_MODULUS} <> 0"),
    "kline_rejects": _sql(f"select first_trade_id as event_id from kline_data where first_trade_id % {CORRUPT_MODULUS} = 0"),
})

ORACLE.update({
    "build_then_stream": ORACLE["stream_avg_close"],
    "build_then_stream_counts": ORACLE["stream_fanout"],
    "stream_avg_close_batches": ORACLE["stream_avg_close"],
})

# Arrivals of plans/streams.py: the slice of a message, one later for stragglers; a row is late if its
# window had ended at the greatest close time of all earlier arrivals.
CUTS = ("2024-01-08", "2024-01-15", "2024-01-22")
_ARRIVALS = f"""
arr as (select *, (first_trade_id % 29 = 3)::integer + {" + ".join(f"(event_time >= timestamp '{c}')::integer" for c in CUTS)} as arrival
  from kline_data),
tops as (select arrival, max(close_ms) as top from arr group by arrival),
seen as (select a.arrival, max(b.top) as top from tops a left join tops b on b.arrival < a.arrival group by a.arrival),
told as (select arr.*, coalesce(close_ms + 1 <= seen.top, false) as late,
  date_trunc('minute', make_timestamp(close_ms * 1000)) as window_start
  from arr join seen using (arrival))"""


def _with_arrivals(body: str) -> str:
    return f"with {CTES.strip()},{_ARRIVALS}\n{body.strip()}"


ORACLE.update({
    "stream_symbols_value_state": ORACLE["symbols"],
    "split_window_merge": ORACLE["stream_avg_close"],
    "compact_then_replay": ORACLE["kline_data"],
    "stream_closed_windows": _with_arrivals(f"""
        select symbol, window_start, round(avg("close"), {DIGITS}) as avg_close from told
        where not late and {_WITHHELD} group by symbol, window_start"""),
    "stream_late_rows": _with_arrivals("""
        select symbol, make_timestamp(close_ms * 1000) as close_time, window_start, "close" from told where late"""),
})
ORACLE["stream_strict_averages"] = ORACLE["stream_closed_windows"]

ORACLE.update({
    "stream_moving_average_5": ORACLE["moving_average_5_all"],
    "stream_price_delta": ORACLE["price_delta_all"],
    "stream_flush_writer": ORACLE["kline_data"],
    "catalog_kline_data": ORACLE["kline_data"],
    "symbol_lookup": _sql(f"""
        select {KD_COLS} from kline_data
        where symbol = 'ERRORBTC' and open_time >= timestamp '{CUTS[0]}' and open_time < timestamp '{CUTS[1]}'"""),
    "stream_two_sources": _sql(f"""
        select symbol, date_trunc('minute', make_timestamp(close_ms * 1000)) as window_start,
          round(avg("close"), {DIGITS}) as avg_close
        from kline_data
        where close_ms + 1 <= (select least(max(close_ms) filter (first_trade_id % 2 = 1), max(close_ms) filter (first_trade_id % 2 = 0))
                               from kline_data)
        group by all"""),
    "relay_faults": ORACLE["relay"] + f" where event_id % {FAULT_MODULUS} not in ({', '.join(map(str, FAULTS.values()))})",
    "relay_balanced": f"""
        with relayed as ({ORACLE["relay"]})
        select count(*) as n, sum(strlen(value))::bigint as bytes, {RELAY_PARTS}::bigint as parts, true as even from relayed""".strip(),
    "orders_between_pruned": ORACLE["orders_between"],
    "orders_monthly_layout": """
        select cast(year(o_orderdate) * 100 + month(o_orderdate) as integer) as month, count(*) as n from orders group by 1""".strip(),
})
