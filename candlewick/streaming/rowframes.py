"""Row-frame windows on a stream: moving average and price change of each update as it arrives.

Spark refuses row-frame windows on streams.  Here each micro-batch runs the bounded
windows of the batch tables (``operators.sequence``) over its rows and the ring: the last
k rows of each symbol so far, which are looked back at but not returned.  The ring is a
table of the warehouse kind: each batch writes the next one as a load that replaces the
last, so it is k rows a symbol, survives restarts, and a replayed batch finds either the
ring it needs or its own work done.  A symbol that holds most of a batch is cut into chunks
like in the batch form, and the ring's top-k is taken in every task before the shuffle.

Rows must come in the order of ``open_time`` and the tie-breakers, batch after batch
(within a batch any order will do).  A row that comes after later ones were answered gets
the frame of the rows before it that are still held; answers already given stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from candlewick.operators.analytics import TIE_BREAK
from candlewick.operators.parse import parse_klines
from candlewick.operators.sequence import DEFAULT_CHUNK_ROWS, chunked_window
from candlewick.operators.tables import to_kline_data
from candlewick.schemas import KLINE_DATA, TableLayout
from candlewick.sources.loads import Loads
from candlewick.sources.warehouse import read_table, stream_load, write_table

_ORDER = ("open_time", *TIE_BREAK)
_RING = TableLayout("ring", T.StructType([KLINE_DATA[c] for c in ("symbol", "close", *_ORDER)]), ("symbol", "open_time"))


def _layout(name: str, *columns: str) -> TableLayout:
    fields = [KLINE_DATA[c] for c in ("symbol", "open_time", "close")]
    return TableLayout(name, T.StructType(fields + [T.StructField(c, T.DoubleType()) for c in columns]), ("symbol", "open_time"))


def moving_average_layout(rows: int = 5) -> TableLayout:
    return _layout("moving_average", f"ma{rows}")


PRICE_DELTA_LAYOUT = _layout("price_delta", "prev_close", "price_delta")


def last_rows(rows: DataFrame, k: int) -> DataFrame:
    """The last k rows of each symbol (a limit in every task before the shuffle)."""
    w = Window.partitionBy("symbol").orderBy(*[F.col(c).desc() for c in (*_ORDER, "close")])
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k).drop("_n")


def start_row_frames(messages: DataFrame, layout: TableLayout, path: str, ring_path: str, checkpoint: str, lookback: int,
                     columns: Callable[[WindowSpec], dict[str, Column]], chunk_rows: int = DEFAULT_CHUNK_ROWS,
                     trigger: dict | None = None, mode: str = "strict") -> StreamingQuery:
    """Window columns over each symbol's updates, appended to the table at ``path`` batch by batch.

    ``columns`` as in ``chunked_window``; derived columns may refer to each other by name
    through a later ``select`` of the reader.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, load = batch.sparkSession, stream_load(checkpoint, batch_id)
        ring = Loads(spark, ring_path)
        if ring.known(load):
            return
        rows = to_kline_data(parse_klines(batch, mode)).select("symbol", "close", *_ORDER).persist()
        try:
            if rows.isEmpty():
                return
            held = read_table(spark, ring_path, _RING)
            both = held.withColumn("held", F.lit(True)).unionByName(rows.withColumn("held", F.lit(False)))
            out = chunked_window(both, ["symbol"], list(_ORDER), lookback, columns, chunk_rows, context=F.col("held"))
            write_table(out, path, layout, clustered=False, load=load)
            write_table(last_rows(both.drop("held"), lookback), ring_path, _RING, clustered=False, load=load,
                        replaces=ring.state().units())
        finally:
            rows.unpersist()

    for table in (path, ring_path):
        Loads(messages.sparkSession, table).create()
    return (messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def start_moving_average(messages: DataFrame, path: str, ring_path: str, checkpoint: str, rows: int = 5, **options) -> StreamingQuery:
    """``moving_average`` on a stream (the mean of the last ``rows`` closes)."""
    return start_row_frames(messages, moving_average_layout(rows), path, ring_path, checkpoint, rows - 1,
                            lambda w: {f"ma{rows}": F.avg("close").over(w.rowsBetween(-(rows - 1), 0))}, **options)


def start_price_delta(messages: DataFrame, path: str, ring_path: str, checkpoint: str, **options) -> StreamingQuery:
    """``price_delta`` on a stream."""
    def columns(w: WindowSpec) -> dict[str, Column]:
        before = F.lag("close", 1).over(w)
        return {"prev_close": before, "price_delta": F.col("close") - before}

    return start_row_frames(messages, PRICE_DELTA_LAYOUT, path, ring_path, checkpoint, 1, columns, **options)
