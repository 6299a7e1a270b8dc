"""Streaming ``kline_agg``: event-time windows closed by the watermark, append mode.

The aggregation itself is ``operators.windows.avg_close`` (the same code as the
batch table).  Lateness: Spark accepts a late row for a window that is still in
state during the micro-batch after the watermark passed it (the watermark of a
batch is the one computed at the end of the previous batch).  ``strict=True`` (the
default) runs with ``spark.sql.streaming.statefulOperator.allowMultiple=false``, which
drops such rows as the reference's stream engine does.  ``streaming.stateful`` has the
form that keeps late rows as data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from candlewick.operators.parse import parse_klines
from candlewick.operators.tables import to_candles
from candlewick.operators.windows import avg_close, close_parts
from candlewick.schemas import AGG_WATERMARK_DELAY, AGG_WINDOW, LAYOUTS
from candlewick.session import session_conf
from candlewick.sources.warehouse import stream_load, write_table

STRICT_LATENESS_CONF = "spark.sql.streaming.statefulOperator.allowMultiple"


def kline_agg_stream(messages: DataFrame, window: str = AGG_WINDOW, delay: str = AGG_WATERMARK_DELAY,
                     mode: str = "strict") -> DataFrame:
    """Streaming DataFrame of finished windows (symbol, window_start, avg_close)."""
    return avg_close(to_candles(parse_klines(messages, mode)), window, delay)


def start_kline_agg(messages: DataFrame, sink_path: str, checkpoint: str, window: str = AGG_WINDOW,
                    delay: str = AGG_WATERMARK_DELAY, strict: bool = True, trigger: dict | None = None,
                    fmt: str = "parquet", mode: str = "strict", table: bool = False) -> StreamingQuery:
    """Start the append-mode windowed average.

    Into a file sink (exactly-once via the sink's log, whose readers see the stream's files
    only), or with ``table=True`` into the warehouse table at ``sink_path``: each
    micro-batch is a load of the averages' parts there, next to loads of batch builds and
    other streams, and readers add up the parts of a window.
    """
    spark = messages.sparkSession
    candles = to_candles(parse_klines(messages, mode))
    agg = close_parts(candles, window, delay) if table else avg_close(candles, window, delay)
    writer = agg.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if table:
        def write(batch: DataFrame, batch_id: int) -> None:
            batch = batch.persist()
            try:
                if not batch.isEmpty():
                    write_table(batch, sink_path, LAYOUTS["kline_agg"], clustered=False,
                                load=stream_load(checkpoint, batch_id), merged=True)
            finally:
                batch.unpersist()
        writer = writer.foreachBatch(write)
    else:
        writer = writer.format(fmt).option("path", sink_path)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    # The setting is read when the query plans its first batch; it is stored in the
    # checkpoint with the query, so restoring the session value afterwards is safe.
    with session_conf(spark, {STRICT_LATENESS_CONF: "false"} if strict else {}):
        return writer.start()
