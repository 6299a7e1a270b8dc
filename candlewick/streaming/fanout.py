"""One message stream fanned out to the four tables.

* ``kline_data``, ``kline_events`` and ``symbols`` share one query: each micro-batch is
  parsed once, persisted, and written to the tables (``foreachBatch``), sorted within
  each task and month-partitioned; of the symbols, only those not stored yet;
* ``kline_agg`` is stateful and runs as its own query with its own checkpoint (it rereads
  the source; a topic read is cheap, state handling stays Spark's).

``foreachBatch`` is at-least-once, so each micro-batch is a load of its own, named after
checkpoint and batch: a replay finds it committed and adds nothing.  Tables built before by a batch job,
a backfill or another stream are simply other loads.  In permissive mode the messages
that do not parse go to the warehouse's rejects.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from candlewick.operators.parse import accepted, checked_klines, parse_klines, rejected
from candlewick.operators.tables import to_kline_data, to_kline_events, to_symbols
from candlewick.schemas import AGG_WATERMARK_DELAY, AGG_WINDOW
from candlewick.sources.warehouse import Warehouse, stream_load
from candlewick.streaming.aggregate import start_kline_agg
from candlewick.streaming.dedupe import add_symbols
from candlewick.streaming.stateful import start_closed_windows


def _stateless_writer(warehouse: Warehouse, mode: str, checkpoint: str, launched, asset_classes):
    def write(batch: DataFrame, batch_id: int) -> None:
        load = stream_load(checkpoint, batch_id)
        # One read and one parse of the batch, also where rejects are kept.
        marked = (checked_klines(batch) if mode == "permissive" else parse_klines(batch, mode)).persist(
            StorageLevel.MEMORY_AND_DISK)
        try:
            klines = accepted(marked) if mode == "permissive" else marked
            warehouse.write("kline_data", to_kline_data(klines), clustered=False, load=load)
            warehouse.write("kline_events", to_kline_events(klines), clustered=False, load=load)
            add_symbols(to_symbols(klines, launched, asset_classes), warehouse.path("symbols"), load)
            if mode == "permissive":
                bad = rejected(marked)
                if not bad.isEmpty():
                    warehouse.write_rejects(bad, load)
        finally:
            marked.unpersist()
    return write


def start_fanout(messages: DataFrame, warehouse: Warehouse, checkpoint_dir: str, mode: str = "strict",
                 launched=None, asset_classes: dict[str, str] | None = None, window: str = AGG_WINDOW,
                 delay: str = AGG_WATERMARK_DELAY, strict_lateness: bool = True,
                 trigger: dict | None = None, keep_late: bool = False) -> dict[str, StreamingQuery]:
    """Start the queries.  ``keep_late`` closes windows by timers and writes late rows to ``kline_late``."""
    trig = trigger or {"availableNow": True}
    ck = checkpoint_dir.rstrip("/")
    warehouse.create_if_missing()
    writer = _stateless_writer(warehouse, mode, f"{ck}/stateless", launched, asset_classes)
    stateless = (messages.writeStream.foreachBatch(writer)
                 .option("checkpointLocation", f"{ck}/stateless").trigger(**trig).start())
    if keep_late:
        agg = start_closed_windows(messages, warehouse, f"{ck}/kline_agg", window, trigger=trig, mode=mode)
    else:
        agg = start_kline_agg(messages, warehouse.path("kline_agg"), f"{ck}/kline_agg", window, delay,
                              strict_lateness, trig, mode=mode, table=True)
    return {"stateless": stateless, "kline_agg": agg}


def await_all(queries: dict[str, StreamingQuery], timeout_s: float | None = None) -> None:
    for q in queries.values():
        q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
