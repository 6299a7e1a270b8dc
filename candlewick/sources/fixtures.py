"""The driver's ``events`` table rendered as raw exchange messages.

Every ``events`` row becomes one JSON text: a control message, a trade message or
an hourly candle update, so that all queries run over data Spark derives from the
given tables and grow with them.  The mapping is fixed (see FIXTURES.md §4).
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture mapping: event_type → symbol (anything else → VIEWXYZ).
EVENT_SYMBOLS = {
    "click": "CLICKUSDT",
    "error": "ERRORBTC",
    "purchase": "PURCHASEBUSD",
    "signup": "SIGNUPETH",
}
OTHER_SYMBOL = "VIEWXYZ"
# Every 50th event id is a control message, the next one a trade; ids with a
# last digit 0 are closed candles.
CONTROL_REMAINDER = 0
TRADE_REMAINDER = 1
MESSAGE_MODULUS = 50
CLOSED_MODULUS = 10
CANDLE_INTERVAL = "1h"
CANDLE_LAST_MS = 3_599_999
# Asset classes that differ from the default in the join check.
ASSET_CLASS_OVERRIDES = {"VIEWXYZ": "other"}
# Error-policy check: kline messages whose event id is a multiple of this get an
# unparsable close price.
CORRUPT_MODULUS = 97
CORRUPT_CLOSE = "n/a"
# Relay check: what happens to the messages whose event id has these remainders.
FAULT_MODULUS = 31
FAULTS = {"empty": 5, "tail": 6, "cut": 7, "array": 8}

KLINE_TEMPLATE = (
    '{"e":"kline","E":%d,"s":"%s","k":{"t":%d,"T":%d,"s":"%s","i":"%s","f":%d,"L":%d,'
    '"o":"%.8f","c":"%.8f","h":"%.8f","l":"%.8f","v":"%.8f","n":%d,"x":%s,'
    '"q":"%.8f","V":"%.8f","Q":"%.8f","B":"0"}}'
)
TRADE_TEMPLATE = '{"e":"trade","E":%d,"s":"%s","t":%d,"p":"%.8f","q":"%.8f","T":%d,"m":true,"M":true}'
CONTROL_TEMPLATE = '{"result":null,"id":%d}'


def event_symbol(event_type: Column) -> Column:
    expr = F.lit(OTHER_SYMBOL)
    for etype, sym in reversed(list(EVENT_SYMBOLS.items())):
        expr = F.when(event_type == etype, F.lit(sym)).otherwise(expr)
    return expr


def events_to_messages(events: DataFrame) -> DataFrame:
    """``events`` → one ``value STRING`` column of raw messages (narrow: no shuffle)."""
    return events.select(events_message().alias("value"))


def events_message() -> Column:
    """The raw message of a row of ``events``."""
    e = F.col("event_id")
    ems = F.unix_millis(F.col("ts").cast("timestamp"))
    hour_ms = F.unix_millis(F.date_trunc("hour", F.col("ts").cast("timestamp")))
    sym = event_symbol(F.col("event_type"))
    kk = F.get_json_object("props", "$.k").cast("int")
    value = F.col("value").cast("double")
    uid = F.col("user_id").cast("double")
    kline = F.format_string(
        KLINE_TEMPLATE,
        ems, sym, hour_ms, hour_ms + F.lit(CANDLE_LAST_MS), sym, F.lit(CANDLE_INTERVAL), e, e + kk,
        value, value, F.floor(value).cast("double") + 1.0, F.floor(value).cast("double"), uid, kk,
        F.when(e % CLOSED_MODULUS == 0, F.lit("true")).otherwise(F.lit("false")),
        uid * 2.0, uid / 2.0, uid,
    )
    trade = F.format_string(TRADE_TEMPLATE, ems, sym, e, value, uid, ems)
    control = F.format_string(CONTROL_TEMPLATE, e)
    r = e % MESSAGE_MODULUS
    return (F.when(r == CONTROL_REMAINDER, control)
            .when(r == TRADE_REMAINDER, trade)
            .otherwise(kline))


def faulty_messages(events: DataFrame) -> DataFrame:
    """The messages with some emptied, cut short, followed by other text, or replaced by another JSON value.

    By the event id's remainder (``FAULTS``): what a relay must drop.
    """
    r = F.col("event_id") % FAULT_MODULUS
    kept = events.withColumn("_m", events_message())
    text = F.col("_m")
    bad = (F.when(r == FAULTS["empty"], F.lit("")).when(r == FAULTS["tail"], F.concat(text, F.lit(" tail")))
           .when(r == FAULTS["cut"], F.substring(text, 1, 20)).when(r == FAULTS["array"], F.concat(F.lit("["), text, F.lit("]")))
           .otherwise(text))
    return kept.select(bad.alias("value"))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


_MESSAGE_FILES: dict[tuple[str, str], str] = {}
_MESSAGE_LOCK = threading.Lock()


def message_files(spark: SparkSession, sf_dir: str) -> str:
    """Text files (one message per line) rendered from ``events``, once per session and input.

    Raw messages arrive as text (a topic or files), so every consumer reads them
    as text; rendering and parsing in one plan would be a fixture artifact.  The
    files are range-partitioned by event time (a stream replay sees them in time
    order) and live under the checkpoint folder (shared on a cluster).
    """
    from candlewick.session import scratch_path

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _MESSAGE_LOCK:
        if key not in _MESSAGE_FILES:
            _MESSAGE_FILES[key] = _render(spark, sf_dir, scratch_path(spark, "messages"))
        return _MESSAGE_FILES[key]


def _render(spark: SparkSession, sf_dir: str, path: str) -> str:
    events = read_events(spark, sf_dir)
    # An explicit count keeps AQE from merging the (small) exchange into one
    # task, which would render every message on one core.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    events = events.repartitionByRange(parts, "ts").sortWithinPartitions("ts")
    events_to_messages(events).write.text(path)
    return path


def fixture_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages derived from ``{sf_dir}/events.parquet`` (``value STRING``)."""
    from candlewick.schemas import RAW_MESSAGE

    return spark.read.schema(RAW_MESSAGE).text(message_files(spark, sf_dir))


def corrupted_messages(messages: DataFrame) -> DataFrame:
    """The messages with the close price of every ``CORRUPT_MODULUS``-th kline replaced by text.

    Used to exercise the permissive parse and the rejects on whole tables.
    """
    v = F.col("value")
    event_id = F.get_json_object(v, "$.k.f").cast("bigint")
    bad = v.contains('"e":"kline"') & (event_id % CORRUPT_MODULUS == 0)
    spoiled = F.regexp_replace(v, '"c":"[^"]*"', f'"c":"{CORRUPT_CLOSE}"')
    return messages.select(F.when(bad, spoiled).otherwise(v).alias("value"))
