"""Streaming entries of the catalogue: each runs a real Structured Streaming query
(file source → stateful operator → file sink, ``availableNow``) over the messages
derived from ``events`` and returns what the sink holds.

The input files are written once per session and input folder.  All files are
present when the query starts, so they form one data micro-batch followed by the
no-data batch that advances the watermark: windows are emitted once the
watermark (max close time, zero delay) has passed their end, the last window of
each symbol stays in state.  Multi-batch behaviour (late rows, restarts) is
covered by the tests.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators.parse import parse_klines
from candlewick.operators.tables import to_kline_data
from candlewick.operators.windows import average, merge_parts
from candlewick.plans.ingest import FIXTURE_LAUNCHED, add_messages, backfill_warehouse, build_warehouse
from candlewick.schemas import KLINE_AGG, KLINE_DATA, LAYOUTS, SYMBOLS
from candlewick.session import configure, scratch_path
from candlewick.sources.fixtures import ASSET_CLASS_OVERRIDES, events_to_messages, message_files, read_events
from candlewick.sources.flush import read_flushed, start_flush
from candlewick.sources.loads import Files
from candlewick.sources.messages import stream_messages
from candlewick.sources.warehouse import Warehouse, read_table
from candlewick.streaming.aggregate import start_kline_agg
from candlewick.streaming.dedupe import start_symbols
from candlewick.streaming.fanout import await_all, start_fanout
from candlewick.streaming.multisource import beat, last_event_ms, start_sources_agg
from candlewick.streaming.relay import start_relay_to_files
from candlewick.streaming.rowframes import (
    PRICE_DELTA_LAYOUT, moving_average_layout, start_moving_average, start_price_delta,
)
from candlewick.streaming.stateful import start_closed_windows

# Where the entries with several arrivals cut the events (hour ends, so windows' ends).
CUTS = ("2024-01-08", "2024-01-15", "2024-01-22")
# Where the loads that split windows are cut (inside hours, and a candle's updates share one window).
SPLITS = ("2024-01-08 12:30:00", "2024-01-15 07:20:00", "2024-01-22 18:45:00")
LOOKUP_SYMBOL = "ERRORBTC"
# Messages that come one arrival late.
STRAGGLERS, STRAGGLER_REMAINDER = 29, 3


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_messages(configure(spark), message_files(spark, sf_dir))


def q_stream_avg_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink, ck = scratch_path(spark, "stream-agg"), scratch_path(spark, "stream-agg-ck")
    q = start_kline_agg(_source(spark, sf_dir), sink, ck)
    q.awaitTermination()
    out = spark.read.schema(KLINE_AGG).parquet(sink)
    return out.withColumn("avg_close", F.round("avg_close", 6))


def _symbols(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    sink, ck = scratch_path(spark, "stream-symbols"), scratch_path(spark, "stream-symbols-ck")
    q = start_symbols(_source(spark, sf_dir), sink, ck, FIXTURE_LAUNCHED, ASSET_CLASS_OVERRIDES, method=method)
    q.awaitTermination()
    if method == "merge":
        return read_table(spark, sink, LAYOUTS["symbols"])
    return spark.read.schema(SYMBOLS).parquet(sink)


def q_stream_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-batch partial dedupe merged into the stored table (the default)."""
    return _symbols(spark, sf_dir, "merge")


def q_stream_symbols_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dropDuplicates`` with the symbols kept in the state store."""
    return _symbols(spark, sf_dir, "state")


_FANOUT: dict[tuple[str, str], Warehouse] = {}
_FANOUT_LOCK = threading.Lock()


def fanout_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The four tables as the streaming fan-out writes them (run once per session and input)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _FANOUT_LOCK:
        if key not in _FANOUT:
            wh = Warehouse(spark, scratch_path(spark, "stream-warehouse"))
            queries = start_fanout(_source(spark, sf_dir), wh, scratch_path(spark, "stream-fanout-ck"),
                                   launched=FIXTURE_LAUNCHED, asset_classes=ASSET_CLASS_OVERRIDES)
            await_all(queries)
            _FANOUT[key] = wh
        return _FANOUT[key]


def q_stream_kline_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kline_data`` as written by the stream's foreachBatch sink (month column dropped)."""
    return fanout_warehouse(configure(spark), sf_dir).table("kline_data").drop("month")


def _row_counts(wh: Warehouse) -> DataFrame:
    parts = []
    for name in ("kline_data", "kline_events", "symbols", "kline_agg"):
        parts.append(wh.table(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _row_counts(fanout_warehouse(configure(spark), sf_dir))


def _slice(spark: SparkSession, sf_dir: str, lo: str | None, hi: str | None, where: Column | None = None,
           spread: bool = False) -> DataFrame:
    """Messages of the events with lo <= ts < hi (of those that ``where`` holds for).

    ``spread``: dealt to as many tasks as the session has shuffle partitions.  A scan has a
    task for each row group that holds such rows, few for a short time in a large file, and
    they would render and parse all of it.  Not for files that a stream takes a few at a
    time: each would hold rows of the whole slice.
    """
    events = read_events(configure(spark), sf_dir)
    if where is not None:
        events = events.where(where)
    if lo is not None:
        events = events.where(F.col("ts") >= F.lit(lo).cast("timestamp"))
    if hi is not None:
        events = events.where(F.col("ts") < F.lit(hi).cast("timestamp"))
    if spread:
        events = events.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return events_to_messages(events)


def _built_then_streamed(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The events before the first cut as a batch build, the rest as a stream into the same tables."""
    wh = Warehouse(spark, scratch_path(configure(spark), "build-then-stream"))
    options = dict(launched=FIXTURE_LAUNCHED, asset_classes=ASSET_CLASS_OVERRIDES)
    build_warehouse(_slice(spark, sf_dir, None, CUTS[1]), wh, **options)
    folder = scratch_path(spark, "messages")
    _slice(spark, sf_dir, CUTS[1], None).write.text(folder)
    await_all(start_fanout(stream_messages(spark, folder), wh, scratch_path(spark, "build-then-stream-ck"), **options))
    return wh


def q_build_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kline_agg`` after a batch build and a stream (the cut lies at a window's end, so none is split)."""
    return _built_then_streamed(spark, sf_dir).table("kline_agg").select(
        "symbol", "window_start", F.round("avg_close", 6).alias("avg_close"))


def q_build_then_stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _row_counts(_built_then_streamed(spark, sf_dir))


def q_compact_after_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kline_data`` after a backfill in several micro-batches and a compaction."""
    wh = Warehouse(spark, scratch_path(configure(spark), "backfilled"))
    backfill_warehouse(spark, message_files(spark, sf_dir), wh, scratch_path(spark, "backfill-ck"),
                       max_files_per_trigger=4, launched=FIXTURE_LAUNCHED, asset_classes=ASSET_CLASS_OVERRIDES)
    wh.compact_all(("kline_data", "kline_events", "symbols", "kline_agg"))
    return wh.table("kline_data").drop("month")


def q_stream_avg_close_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windowed average over files that arrive slice by slice, the query restarted for each (strict lateness)."""
    folder, sink, ck = (scratch_path(configure(spark), n) for n in ("messages", "stream-agg", "stream-agg-ck"))
    for lo, hi in zip((None, *CUTS), (*CUTS, None)):
        _slice(spark, sf_dir, lo, hi).write.mode("append").text(folder)
        start_kline_agg(stream_messages(spark, folder), sink, ck, strict=True).awaitTermination()
    return spark.read.schema(KLINE_AGG).parquet(sink).withColumn("avg_close", F.round("avg_close", 6))


def q_stream_symbols_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The symbols over the same arrivals and restarts."""
    folder, sink, ck = (scratch_path(configure(spark), n) for n in ("messages", "stream-symbols", "stream-symbols-ck"))
    for lo, hi in zip((None, *CUTS), (*CUTS, None)):
        _slice(spark, sf_dir, lo, hi).write.mode("append").text(folder)
        start_symbols(stream_messages(spark, folder), sink, ck, FIXTURE_LAUNCHED, ASSET_CLASS_OVERRIDES).awaitTermination()
    return read_table(spark, sink, LAYOUTS["symbols"])


def q_stream_symbols_value_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The symbols from a keyed value state, over the same arrivals and restarts."""
    folder, sink, ck = (scratch_path(configure(spark), n) for n in ("messages", "stream-symbols", "stream-symbols-ck"))
    for lo, hi in zip((None, *CUTS), (*CUTS, None)):
        _slice(spark, sf_dir, lo, hi).write.mode("append").text(folder)
        start_symbols(stream_messages(spark, folder), sink, ck, FIXTURE_LAUNCHED, ASSET_CLASS_OVERRIDES,
                      method="value_state").awaitTermination()
    return read_table(spark, sink, LAYOUTS["symbols"])


# -- loads that split windows, compaction, replay ----------------------------

def q_split_window_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kline_agg`` from a build, a further batch load, a backfill and the stream after it, cut inside windows.

    Compacted in between.  Every window has one average; the stream withholds the last ones.
    """
    wh = Warehouse(spark, scratch_path(configure(spark), "split-windows"))
    options = dict(launched=FIXTURE_LAUNCHED, asset_classes=ASSET_CLASS_OVERRIDES)
    one, two, three = SPLITS
    build_warehouse(_slice(spark, sf_dir, None, one), wh, **options)
    add_messages(_slice(spark, sf_dir, one, two), wh, **options)
    folder, ck = scratch_path(spark, "messages"), scratch_path(spark, "split-windows-ck")
    _slice(spark, sf_dir, two, three).write.text(folder)
    backfill_warehouse(spark, folder, wh, ck, max_files_per_trigger=4, **options)
    wh.compact("kline_agg")
    _slice(spark, sf_dir, three, None).write.mode("append").text(folder)
    await_all(start_fanout(stream_messages(spark, folder), wh, ck, **options))
    return wh.table("kline_agg").withColumn("avg_close", F.round("avg_close", 6))


def replay_last_batch(spark: SparkSession, checkpoint: str) -> None:
    """Take back a stopped query's last commit, as if it had died before it: the next start runs that batch again."""
    files = Files(spark)
    batches = [int(n) for n in files.names(f"{checkpoint}/commits") if n.isdigit()]
    files.delete(f"{checkpoint}/commits/{max(batches)}")


def q_compact_then_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kline_data`` after a backfill in several batches, a compaction, and a replay of its last batch."""
    wh = Warehouse(spark, scratch_path(configure(spark), "replayed"))
    ck = scratch_path(spark, "replayed-ck")
    options = dict(max_files_per_trigger=4, launched=FIXTURE_LAUNCHED, asset_classes=ASSET_CLASS_OVERRIDES)
    backfill_warehouse(spark, message_files(spark, sf_dir), wh, ck, **options)
    wh.compact_all(("kline_data", "kline_events", "symbols", "kline_agg"))
    replay_last_batch(spark, f"{ck}/stateless")
    backfill_warehouse(spark, message_files(spark, sf_dir), wh, ck, **options)
    return wh.table("kline_data").drop("month")


def q_symbol_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One symbol's updates of some days, from the files that can hold them, after a backfill and a compaction."""
    wh = Warehouse(spark, scratch_path(configure(spark), "lookup"))
    backfill_warehouse(spark, message_files(spark, sf_dir), wh, scratch_path(spark, "lookup-ck"), max_files_per_trigger=4,
                       launched=FIXTURE_LAUNCHED, asset_classes=ASSET_CLASS_OVERRIDES)
    wh.compact("kline_data")
    add_messages(_slice(spark, sf_dir, None, CUTS[0], spread=True), wh, launched=FIXTURE_LAUNCHED, asset_classes=ASSET_CLASS_OVERRIDES)
    return wh.lookup("kline_data", LOOKUP_SYMBOL, CUTS[0], CUTS[1]).drop("month")


def q_catalog_kline_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kline_data`` by its catalogue name: tables created twice, a build, two more loads, a compaction of some months."""
    database = f"market_{uuid.uuid4().hex[:12]}"
    wh = Warehouse(spark, scratch_path(configure(spark), "catalogued"), database)
    options = dict(launched=FIXTURE_LAUNCHED, asset_classes=ASSET_CLASS_OVERRIDES)
    wh.create_if_missing()
    wh.create_if_missing()
    one, two, _ = SPLITS
    build_warehouse(_slice(spark, sf_dir, None, one, spread=True), wh, **options)
    add_messages(_slice(spark, sf_dir, one, two, spread=True), wh, **options)
    wh.compact("kline_data")
    add_messages(_slice(spark, sf_dir, two, None, spread=True), wh, **options)
    return spark.sql(f"SELECT * FROM {database}.kline_data").drop("load", "month")


# -- rows that come late -----------------------------------------------------

def _with_stragglers(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The arrivals, with some messages one arrival late (so there is one arrival more)."""
    events = read_events(configure(spark), sf_dir)
    slow = (F.col("event_id") % STRAGGLERS == STRAGGLER_REMAINDER).cast("int")
    arrival = slow
    for cut in CUTS:
        arrival = arrival + (F.col("ts") >= F.lit(cut).cast("timestamp")).cast("int")
    return [events_to_messages(events.where(arrival == k)) for k in range(len(CUTS) + 2)]


_LATE: dict[tuple[str, str], Warehouse] = {}
_LATE_LOCK = threading.Lock()


def late_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Averages of windows closed by timers and their late rows, the query restarted for each arrival."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LATE_LOCK:
        if key not in _LATE:
            wh = Warehouse(spark, scratch_path(configure(spark), "late"))
            folder, ck = scratch_path(spark, "messages"), scratch_path(spark, "late-ck")
            for messages in _with_stragglers(spark, sf_dir):
                messages.write.mode("append").text(folder)
                start_closed_windows(stream_messages(spark, folder), wh, ck).awaitTermination()
            _LATE[key] = wh
        return _LATE[key]


def q_stream_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_warehouse(configure(spark), sf_dir).table("kline_agg").withColumn("avg_close", F.round("avg_close", 6))


def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_warehouse(configure(spark), sf_dir).table("kline_late").drop("month")


def q_stream_strict_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The engine's own windows over the same arrivals: late rows are dropped by default."""
    folder, sink, ck = (scratch_path(configure(spark), n) for n in ("messages", "stream-agg", "stream-agg-ck"))
    for messages in _with_stragglers(spark, sf_dir):
        messages.write.mode("append").text(folder)
        start_kline_agg(stream_messages(spark, folder), sink, ck).awaitTermination()
    return spark.read.schema(KLINE_AGG).parquet(sink).withColumn("avg_close", F.round("avg_close", 6))


# -- row-frame windows, several sources ---------------------------------------

def _arrivals(spark: SparkSession, sf_dir: str, start) -> None:
    """Write the slices one after the other into a folder and run the query that ``start`` starts over it for each."""
    folder = scratch_path(configure(spark), "messages")
    for lo, hi in zip((None, *CUTS), (*CUTS, None)):
        _slice(spark, sf_dir, lo, hi, spread=True).write.mode("append").text(folder)
        start(stream_messages(spark, folder)).awaitTermination()


def q_stream_moving_average_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5-row moving average of every symbol, update by update, over four arrivals with restarts."""
    out, ring, ck = (scratch_path(configure(spark), n) for n in ("stream-ma", "stream-ma-ring", "stream-ma-ck"))
    _arrivals(spark, sf_dir, lambda m: start_moving_average(m, out, ring, ck, 5))
    return read_table(spark, out, moving_average_layout(5)).withColumn("ma5", F.round("ma5", 6))


def q_stream_price_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, ring, ck = (scratch_path(configure(spark), n) for n in ("stream-delta", "stream-delta-ring", "stream-delta-ck"))
    _arrivals(spark, sf_dir, lambda m: start_price_delta(m, out, ring, ck))
    return read_table(spark, out, PRICE_DELTA_LAYOUT)


def q_stream_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windowed average of two sources of which one is always an arrival behind: no row is late."""
    names = ("source-odd", "source-even", "two-sources", "two-sources-ck")
    odd, even, sink, ck = (scratch_path(configure(spark), n) for n in names)
    bounds = list(zip((None, *CUTS), (*CUTS, None)))
    for k in range(len(bounds) + 1):
        for folder, at, rest in ((odd, k, 1), (even, k - 1, 0)):
            Files(spark).mkdirs(folder)
            if 0 <= at < len(bounds):
                _slice(spark, sf_dir, *bounds[at], where=F.col("event_id") % 2 == rest).write.mode("append").text(folder)
            elif at >= len(bounds):
                beat(spark, folder, last_event_ms(spark, folder))      # this source has ended
        start_sources_agg([stream_messages(spark, odd), stream_messages(spark, even)], sink, ck).awaitTermination()
    parts = merge_parts(read_table(spark, sink, LAYOUTS["kline_agg"]))
    return parts.select("symbol", "window_start", F.round(average(), 6).alias("avg_close"))


def q_stream_flush_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kline_data`` through the sink that flushes by number or time."""
    out, ck = scratch_path(configure(spark), "flushed"), scratch_path(spark, "flushed-ck")
    start_flush(to_kline_data(parse_klines(_source(spark, sf_dir))), out, ck, batch_rows=1000).awaitTermination()
    return read_flushed(spark, out, KLINE_DATA)


def q_stream_relay(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink, ck = scratch_path(spark, "stream-relay"), scratch_path(spark, "stream-relay-ck")
    q = start_relay_to_files(_source(spark, sf_dir), sink, ck)
    q.awaitTermination()
    return spark.read.schema("key string, value string").json(sink)


STREAM_QUERIES = {
    "stream_avg_close": q_stream_avg_close,
    "stream_symbols": q_stream_symbols,
    "stream_symbols_state": q_stream_symbols_state,
    "stream_fanout": q_stream_fanout,
    "stream_relay": q_stream_relay,
    "stream_kline_data": q_stream_kline_data,
    "build_then_stream": q_build_then_stream,
    "build_then_stream_counts": q_build_then_stream_counts,
    "compact_after_backfill": q_compact_after_backfill,
    "stream_avg_close_batches": q_stream_avg_close_batches,
    "stream_symbols_restart": q_stream_symbols_restart,
    "stream_symbols_value_state": q_stream_symbols_value_state,
    "split_window_merge": q_split_window_merge,
    "compact_then_replay": q_compact_then_replay,
    "catalog_kline_data": q_catalog_kline_data,
    "symbol_lookup": q_symbol_lookup,
    "stream_closed_windows": q_stream_closed_windows,
    "stream_late_rows": q_stream_late_rows,
    "stream_strict_averages": q_stream_strict_averages,
    "stream_moving_average_5": q_stream_moving_average_5,
    "stream_price_delta": q_stream_price_delta,
    "stream_two_sources": q_stream_two_sources,
    "stream_flush_writer": q_stream_flush_writer,
}
