"""Streaming ``symbols``: first sighting of each symbol.

Two forms:

* ``method="merge"`` (default): ``foreachBatch`` de-duplicates each micro-batch as
  a batch aggregate — a map-side partial step leaves one row per symbol per task
  before the shuffle, so a symbol carrying a third of the messages costs nothing
  extra — then appends only the symbols missing from the stored table (left
  anti join against it; the table is one row per symbol).  The table itself is
  the state: a replayed batch finds its symbols already stored and appends
  nothing, and a restart continues from the table.
* ``method="state"``: ``dropDuplicates(["symbol"])`` without a watermark keeps one
  state row per symbol in the state store for the life of the checkpoint (like
  the reference's keyed flag, but surviving restarts).  Streaming dedupe has no
  partial step, so each task first reduces its rows to one a symbol.  Its sink is a
  plain file sink: not for a warehouse table;
* ``method="value_state"``: a keyed value state (``streaming.stateful``), each
  micro-batch a load of the warehouse table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.operators.parse import parse_klines
from candlewick.operators.tables import to_symbols
from candlewick.schemas import LAYOUTS
from candlewick.sources.loads import Loads
from candlewick.sources.warehouse import read_table, stream_load, write_table
from candlewick.streaming.stateful import once_a_task, start_symbols_value_state

METHODS = ("merge", "state", "value_state")


def symbols_stream(messages: DataFrame, launched=None, asset_classes: dict[str, str] | None = None,
                   mode: str = "strict") -> DataFrame:
    """The state-store form as a streaming DataFrame."""
    klines = parse_klines(messages, mode).select("symbol").where(F.col("symbol").isNotNull())
    return to_symbols(klines.mapInArrow(once_a_task, "symbol string"), launched, asset_classes)


def add_symbols(fresh: DataFrame, sink_path: str, load: str) -> None:
    """Append the symbols that the table does not hold yet, as one load; no file if there are none."""
    spark = fresh.sparkSession
    stored = read_table(spark, sink_path, LAYOUTS["symbols"]).select("symbol")
    new = fresh.join(stored, "symbol", "left_anti").persist()
    try:
        if not new.isEmpty():
            write_table(new, sink_path, LAYOUTS["symbols"], clustered=False, load=load)
    finally:
        new.unpersist()


def _merge_writer(sink_path: str, launched, asset_classes, mode: str, checkpoint: str = ""):
    def merge(batch: DataFrame, batch_id: int) -> None:
        fresh = to_symbols(parse_klines(batch, mode), launched, asset_classes)
        add_symbols(fresh, sink_path, stream_load(checkpoint, batch_id))
    return merge


def start_symbols(messages: DataFrame, sink_path: str, checkpoint: str, launched=None,
                  asset_classes: dict[str, str] | None = None, trigger: dict | None = None,
                  method: str = "merge", mode: str = "strict") -> StreamingQuery:
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, got {method!r}")
    trig = trigger or {"availableNow": True}
    if method == "value_state":
        return start_symbols_value_state(messages, sink_path, checkpoint, launched, asset_classes, trig, mode)
    if method == "state":
        out = symbols_stream(messages, launched, asset_classes, mode)
        return (out.writeStream.outputMode("append").format("parquet")
                .option("path", sink_path).option("checkpointLocation", checkpoint)
                .trigger(**trig).start())
    Loads(messages.sparkSession, sink_path).create()
    return (messages.writeStream.foreachBatch(_merge_writer(sink_path, launched, asset_classes, mode, checkpoint))
            .option("checkpointLocation", checkpoint).trigger(**trig).start())
