"""The windowed average over several message sources that run at different paces.

Each source has its own watermark, and the engine's minimum policy closes a window only
when every source has passed it, so a source that lags behind loses no row to a faster
one.  A source that falls idle would hold all windows open: a heartbeat message in it,
``{"e":"heartbeat","E":<epoch ms>}``, vouches that nothing earlier will come, and moves its
watermark without being a row.  ``beat_idle`` writes one into each idle folder.  After a
restart the engine knows of a source only what it sends from then on, so a source that has
ended, or pauses over a restart, needs one too (at its own ``last_event_ms``).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.functions.time import millis_to_ts
from candlewick.operators.parse import parse_klines
from candlewick.operators.tables import to_candles
from candlewick.operators.windows import average
from candlewick.schemas import AGG_WATERMARK_DELAY, AGG_WINDOW, LAYOUTS
from candlewick.session import session_conf
from candlewick.sources.loads import Files
from candlewick.sources.messages import read_messages
from candlewick.sources.warehouse import stream_load, write_table
from candlewick.streaming.aggregate import STRICT_LATENESS_CONF

HEARTBEAT_MARKER = '"e":"heartbeat"'
HEARTBEAT = '{"e":"heartbeat","E":%d}'
#: Seconds without a new file after which a source counts as idle.
IDLE_S = 5.0


def heartbeat_times(messages: DataFrame) -> DataFrame:
    """``close_time_ms`` of the heartbeats."""
    beats = messages.where(F.col("value").contains(HEARTBEAT_MARKER))
    return beats.select(F.get_json_object("value", "$.E").try_cast("bigint").alias("close_time_ms")).where(
        "close_time_ms is not null")


def timed_source(messages: DataFrame, delay: str, mode: str) -> DataFrame:
    """(symbol, close, _event_ts) of one source under its own watermark."""
    rows = to_candles(parse_klines(messages, mode)).select("symbol", "close", "close_time_ms")
    beats = heartbeat_times(messages).select(F.lit(None).cast("string").alias("symbol"), F.lit(None).cast("double").alias("close"),
                                             "close_time_ms")
    timed = rows.unionByName(beats).select("symbol", "close", millis_to_ts("close_time_ms").alias("_event_ts"))
    # The heartbeat goes after it has moved the watermark: a condition that names the event
    # time is not moved before it by the optimizer.
    return timed.withWatermark("_event_ts", delay).where(F.when(F.col("_event_ts").isNotNull(), F.col("symbol").isNotNull()))


def sources_parts(sources: Sequence[DataFrame], window: str = AGG_WINDOW, delay: str = AGG_WATERMARK_DELAY,
                  mode: str = "strict") -> DataFrame:
    """(symbol, window_start, close_sum, close_count) of the windows that all sources have passed."""
    rows = reduce(DataFrame.unionByName, [timed_source(m, delay, mode) for m in sources])
    agg = rows.groupBy(F.window("_event_ts", window).alias("_w"), "symbol").agg(
        F.sum("close").alias("close_sum"), F.count("close").alias("close_count"))
    return agg.select("symbol", F.col("_w.start").alias("window_start"), "close_sum", "close_count")


def start_sources_agg(sources: Sequence[DataFrame], sink_path: str, checkpoint: str, window: str = AGG_WINDOW,
                      delay: str = AGG_WATERMARK_DELAY, strict: bool = True, trigger: dict | None = None,
                      mode: str = "strict", table: bool = True) -> StreamingQuery:
    """The averages of all sources together: loads of the warehouse table at ``sink_path``, or a file sink."""
    parts = sources_parts(sources, window, delay, mode)
    if table:
        def write(batch: DataFrame, batch_id: int) -> None:
            batch = batch.persist()
            try:
                if not batch.isEmpty():
                    write_table(batch, sink_path, LAYOUTS["kline_agg"], clustered=False,
                                load=stream_load(checkpoint, batch_id), merged=True)
            finally:
                batch.unpersist()
        writer = parts.writeStream.foreachBatch(write)
    else:
        writer = parts.select("symbol", "window_start", average()).writeStream.format("parquet").option("path", sink_path)
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    settings = {"spark.sql.streaming.multipleWatermarkPolicy": "min"}
    with session_conf(sources[0].sparkSession, settings | ({STRICT_LATENESS_CONF: "false"} if strict else {})):
        return writer.start()


def last_event_ms(spark: SparkSession, folder: str) -> int | None:
    """Greatest close time of the messages in a source's folder (a partial maximum in every task)."""
    rows = to_candles(parse_klines(read_messages(spark, folder), "permissive"))
    return rows.agg(F.max("close_time_ms")).first()[0]


def beat(spark: SparkSession, folder: str, event_ms: int) -> None:
    """Write a heartbeat into a source's folder."""
    Files(spark).create(f"{folder.rstrip('/')}/heartbeat-{uuid.uuid4().hex}.txt", HEARTBEAT % event_ms + "\n")


def beat_idle(spark: SparkSession, folders: Sequence[str], event_ms: int, idle_s: float = IDLE_S) -> list[str]:
    """Heartbeats at ``event_ms`` for the folders without a new file for ``idle_s`` seconds, unless all are idle."""
    files, idle = Files(spark), []
    for folder in folders:
        ages = [files.age_s(f"{folder}/{n}") for n in files.names(folder) if not n.startswith(("_", "."))]
        if min(ages, default=time.time()) >= idle_s:
            idle.append(folder)
    if len(idle) == len(folders):
        return []
    for folder in idle:
        beat(spark, folder, event_ms)
    return idle
