"""Batch ingest: raw messages → the four stored tables.

The messages are parsed once and the parsed candles persisted, so the four
writes (kline_data, kline_events, symbols, kline_agg) share one JSON pass.
Persisted blocks lost with an executor are recomputed from lineage.  The four
writes are independent jobs and are submitted together, so the scheduler can
interleave their stages instead of running them back to back.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from candlewick.operators.parse import parse_klines
from candlewick.operators.tables import to_candles, to_kline_data, to_kline_events, to_symbols
from candlewick.operators.windows import close_parts
from candlewick.schemas import AGG_WINDOW
from candlewick.session import checkpoint_root
from candlewick.sources.fixtures import ASSET_CLASS_OVERRIDES, fixture_messages
from candlewick.sources.warehouse import Warehouse

# Fixed processing date written as ``launched`` for fixture runs (date of the sample message).
FIXTURE_LAUNCHED = dt.date(2025, 7, 13)
_BUILD_VERSION = "1"


def build_warehouse(messages: DataFrame, warehouse: Warehouse, mode: str = "strict",
                    launched=None, asset_classes: dict[str, str] | None = None,
                    window: str = AGG_WINDOW) -> Warehouse:
    """(Re)build the four tables from all of ``messages`` (overwrites them).

    Loads of ``add_messages``, backfills and streams stand next to this one in the same
    tables afterwards; a window that is split between them has one average.
    """
    return _load(messages, warehouse, mode, launched, asset_classes, window, "overwrite")


def add_messages(messages: DataFrame, warehouse: Warehouse, mode: str = "strict", launched=None,
                 asset_classes: dict[str, str] | None = None, window: str = AGG_WINDOW) -> Warehouse:
    """Add ``messages`` to the tables as one more batch load; of the symbols those not stored yet."""
    warehouse.create_if_missing()
    return _load(messages, warehouse, mode, launched, asset_classes, window, "append")


def _load(messages, warehouse, mode, launched, asset_classes, window, write_mode) -> Warehouse:
    klines = parse_klines(messages, mode).persist(StorageLevel.MEMORY_AND_DISK)
    symbols = to_symbols(klines, launched, asset_classes)
    if write_mode == "append":
        symbols = symbols.join(warehouse.table("symbols").select("symbol"), "symbol", "left_anti")
    tables = {
        "kline_data": to_kline_data(klines),
        "kline_events": to_kline_events(klines),
        "symbols": symbols,
        "kline_agg": close_parts(to_candles(klines), window),
    }
    try:
        # No separate pass to fill the cache: the concurrent writes fill it, a block
        # being computed by one task is waited for (not recomputed) by the others.
        with ThreadPoolExecutor(max_workers=len(tables)) as pool:
            futures = [pool.submit(warehouse.write, name, df, write_mode, merged=name == "kline_agg")
                       for name, df in tables.items()]
            for f in futures:
                f.result()
    finally:
        klines.unpersist()
    return warehouse


_BUILT: dict[tuple[str, str], Warehouse] = {}
_BUILD_LOCK = threading.Lock()   # concurrent callers wait for one build


def fixture_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse built from ``{sf_dir}/events.parquet``, once per session and input.

    Stored under the session's checkpoint folder (the shared folder on a cluster).
    """
    sf_dir = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, sf_dir)
    with _BUILD_LOCK:
        if key not in _BUILT:
            _BUILT[key] = _build_fixture_warehouse(spark, sf_dir, key)
        return _BUILT[key]


def _build_fixture_warehouse(spark: SparkSession, sf_dir: str, key: tuple[str, str]) -> Warehouse:
    tag = hashlib.sha1(f"{_BUILD_VERSION}:{key[0]}:{sf_dir}".encode()).hexdigest()[:16]
    # The folder is private to this application (the tag includes its id), so it
    # is always built fresh: a warehouse written by other code is never reused.
    wh = Warehouse(spark, f"{checkpoint_root(spark)}/warehouse/{tag}")
    build_warehouse(fixture_messages(spark, sf_dir), wh, launched=FIXTURE_LAUNCHED,
                    asset_classes=ASSET_CLASS_OVERRIDES)
    return wh


def backfill_warehouse(spark: SparkSession, messages_path: str, warehouse: Warehouse, checkpoint_dir: str,
                       max_files_per_trigger: int = 1000, launched=None,
                       asset_classes: dict[str, str] | None = None, mode: str = "strict") -> None:
    """Load a large folder of message files through the streaming fan-out, in bounded micro-batches.

    Nothing is cached across the whole input: each micro-batch (at most
    ``max_files_per_trigger`` files) is parsed once and appended to the tables;
    state (open windows, known symbols) carries over between batches.  The same
    checkpoint continues as the live stream afterwards.  Windows whose end the
    watermark has not passed stay open, as in any stream.
    """
    from candlewick.sources.messages import stream_messages
    from candlewick.streaming.fanout import await_all, start_fanout

    messages = stream_messages(spark, messages_path, max_files_per_trigger)
    queries = start_fanout(messages, warehouse, checkpoint_dir, launched=launched,
                           asset_classes=asset_classes, mode=mode)
    await_all(queries)
