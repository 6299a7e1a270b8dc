"""Stateful processors: first sightings in a value state, windows closed by timers with late rows as data.

Both keep their state in the state store of the query's checkpoint (RocksDB) and take
grouped rows as pandas frames.  What can be reduced before the shuffle is: sightings to
one row a symbol and task, and window sums are kept for (symbol, salt), so a symbol that
holds a third of all messages is spread over ``SALTS`` tasks; the parts of a window's
average that different salts emit are added up by the readers of ``kline_agg``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from candlewick.functions.time import millis_to_ts
from candlewick.operators.parse import parse_klines
from candlewick.operators.tables import to_candles, to_symbols
from candlewick.schemas import AGG_WINDOW, LAYOUTS
from candlewick.session import session_conf
from candlewick.sources.warehouse import Warehouse, stream_load, write_table

ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
#: Tasks over which one symbol's rows are spread.
SALTS = 8
#: How late a row may be to be recorded as late (rows later than this are dropped by the engine).
HORIZON_DAYS = 365
_DAY_MS = 86_400_000


# -- first sightings --------------------------------------------------------

class FirstSeen(StatefulProcessor):
    """Emits a key once, for the life of the checkpoint."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for _ in rows:
            pass
        if not self.seen.exists():
            self.seen.update((True,))
            yield pd.DataFrame({"symbol": [key[0]]})

    def close(self) -> None:
        pass


def once_a_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct symbols of one task."""
    found: set = set()
    for batch in batches:
        found |= set(pc.unique(batch.column(0)).to_pylist())
    yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["symbol"])


def first_symbols(messages: DataFrame, launched=None, asset_classes: dict[str, str] | None = None,
                  mode: str = "strict") -> DataFrame:
    """Streaming ``symbols`` rows, each when its symbol is first seen."""
    klines = parse_klines(messages, mode).select("symbol").where(F.col("symbol").isNotNull())
    few = klines.mapInArrow(once_a_task, "symbol string")
    fresh = few.groupBy("symbol").transformWithStateInPandas(FirstSeen(), "symbol string", "append", "none")
    return to_symbols(fresh, launched, asset_classes, distinct=False)


def start_symbols_value_state(messages: DataFrame, sink_path: str, checkpoint: str, launched=None,
                              asset_classes: dict[str, str] | None = None, trigger: dict | None = None,
                              mode: str = "strict") -> StreamingQuery:
    """``first_symbols`` into the warehouse table at ``sink_path``, each micro-batch one load."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                write_table(batch, sink_path, LAYOUTS["symbols"], clustered=False, load=stream_load(checkpoint, batch_id))
        finally:
            batch.unpersist()

    writer = (first_symbols(messages, launched, asset_classes, mode).writeStream.outputMode("append").foreachBatch(write)
              .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})))
    with session_conf(messages.sparkSession, ROCKSDB):
        return writer.start()


# -- windows closed by timers, late rows as data ----------------------------

class ClosedWindows(StatefulProcessor):
    """Sums of each open window; a timer at its end emits them.  Rows of closed windows come out as they are.

    The engine's watermark runs ``horizon_ms`` behind the greatest event time, so that it
    does not drop the rows that are late here; the window's own watermark is ahead of it
    by just that.  Only open windows are kept.
    """

    def __init__(self, horizon_ms: int):
        self.horizon_ms = horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # By window end, which is what a timer knows.
        self.open = handle.getMapState("open", "window_end long", "window_start long, close_sum double, close_count long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() + self.horizon_ms
        for part in rows:
            late = part["window_end"] <= now
            if late.any():
                gone = part[late]
                yield pd.DataFrame({"late": True, "symbol": gone["symbol"], "window_start": gone["window_start"],
                                    "close_sum": gone["close"], "close_count": 1, "close_time": gone["close_time_ms"]})
            sums = part[~late].groupby(["window_end", "window_start"])["close"].agg(["sum", "count"])
            for (end, start), total, n in zip(sums.index, sums["sum"], sums["count"]):
                at = (int(end),)
                if self.open.containsKey(at):
                    _, before, m = self.open.getValue(at)
                else:
                    before, m = 0.0, 0
                    self.handle.registerTimer(int(end) - self.horizon_ms)
                self.open.updateValue(at, (int(start), float(before + total), int(m + n)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = (expiredTimerInfo.getExpiryTimeInMs() + self.horizon_ms,)
        if self.open.containsKey(at):
            start, total, n = self.open.getValue(at)
            self.open.removeKey(at)
            yield pd.DataFrame({"late": [False], "symbol": [key[0]], "window_start": [start], "close_sum": [total],
                                "close_count": [n], "close_time": pd.array([None], "Int64")})

    def close(self) -> None:
        pass


_CLOSED = "late boolean, symbol string, window_start long, close_sum double, close_count long, close_time long"


def closed_windows(candles: DataFrame, window: str = AGG_WINDOW, horizon_days: int = HORIZON_DAYS,
                   salts: int = SALTS) -> DataFrame:
    """Closed windows (``late`` false: window_start, close_sum, close_count) and late rows (``late`` true: close_time too).

    A row is late if its window had ended when the greatest close time of all earlier
    micro-batches was seen.  Event times must be more than ``horizon_days`` after 1970.
    """
    ts = millis_to_ts("close_time_ms")
    timed = candles.select("symbol", "close_time_ms", "close", ts.alias("_event_ts")).withWatermark(
        "_event_ts", f"{horizon_days} days")
    w = F.window("_event_ts", window)
    rows = timed.select("symbol", "close_time_ms", "close", "_event_ts", w.alias("_w")).select(
        "symbol", "close_time_ms", "close", "_event_ts", F.unix_millis("_w.start").alias("window_start"),
        F.unix_millis("_w.end").alias("window_end"),
        F.pmod(F.xxhash64("close_time_ms", "close"), F.lit(salts)).cast("int").alias("salt"))
    return rows.groupBy("symbol", "salt").transformWithStateInPandas(
        ClosedWindows(horizon_days * _DAY_MS), _CLOSED, "append", "eventTime")


def start_closed_windows(messages: DataFrame, warehouse: Warehouse, checkpoint: str, window: str = AGG_WINDOW,
                         horizon_days: int = HORIZON_DAYS, salts: int = SALTS, trigger: dict | None = None,
                         mode: str = "strict") -> StreamingQuery:
    """The windowed average into ``kline_agg`` (parts, each micro-batch one load), its late rows into ``kline_late``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        load = stream_load(checkpoint, batch_id)
        batch = batch.withColumns({"window_start": millis_to_ts("window_start"), "close_time": millis_to_ts("close_time")}).persist()
        try:
            closed, late = batch.where(~F.col("late")), batch.where("late")
            if not closed.isEmpty():
                write_table(closed, warehouse.path("kline_agg"), LAYOUTS["kline_agg"], clustered=False, load=load)
            if not late.isEmpty():
                write_table(late.withColumn("close", F.col("close_sum")), warehouse.path("kline_late"), LAYOUTS["kline_late"],
                            clustered=False, load=load)
        finally:
            batch.unpersist()

    warehouse.create_if_missing()
    found = closed_windows(to_candles(parse_klines(messages, mode)), window, horizon_days, salts)
    writer = (found.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
              .trigger(**(trigger or {"availableNow": True})))
    with session_conf(messages.sparkSession, ROCKSDB):
        return writer.start()
