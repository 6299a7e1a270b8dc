"""A stream sink that flushes by number of rows or time, with retries: ``format("candlewick_flush")``.

Each task holds at most ``batch_rows`` rows and writes them as one Parquet file when that
many are there or ``interval_ms`` has gone by; a write that fails is tried ``retries`` times
more, with growing pauses.  Files count once their micro-batch is committed: the driver then
writes one record with their names.  A task that fails, or a batch that is run again, leaves
files that no record names (they are deleted when the writer learns of it), so no row is
lost or doubled.  ``read_flushed`` reads what is committed.

Options: ``path`` (a shared folder), ``stream`` (a name for the checkpoint: batches of
different streams into one folder are told apart), ``batch_rows``, ``interval_ms``,
``retries``.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from candlewick.sources.loads import Files

NAME = "candlewick_flush"
#: Rows, milliseconds and retries of a flush, as the reference's sinks have them in kind (there: 5, 200, 3).
BATCH_ROWS, INTERVAL_MS, RETRIES = 50_000, 200, 3
_COMMITS = "_commits"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it, for a plain path or a URI."""
    return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and
                                  not path.startswith("file://") else path)


def retried(send: Callable[[], None], retries: int, pause_s: float = 0.05) -> None:
    """Call ``send`` until it works, ``retries`` times more at most."""
    for k in range(retries + 1):
        try:
            return send()
        except OSError:
            if k == retries:
                raise
            time.sleep(pause_s * 2 ** k)


def flush_all(batches: Iterator[pa.RecordBatch], send: Callable[[pa.Table], None], batch_rows: int, interval_ms: int,
              retries: int, clock: Callable[[], float] = time.monotonic) -> None:
    """Hand the rows to ``send`` in tables of ``batch_rows`` at most, at the latest ``interval_ms`` after the last."""
    held: list[pa.RecordBatch] = []
    rows, last = 0, clock()

    def flush() -> None:
        nonlocal rows, last
        if rows:
            table = pa.Table.from_batches(held)
            retried(lambda: send(table), retries)
        held.clear()
        rows, last = 0, clock()

    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, batch_rows - rows)
            held.append(part)
            rows += part.num_rows
            batch = batch.slice(part.num_rows)
            if rows == batch_rows or (clock() - last) * 1000 >= interval_ms:
                flush()
    flush()


@dataclass
class Flushed(WriterCommitMessage):
    files: list[str]


class FlushWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.stream = options.get("stream", "stream")
        self.batch_rows = int(options.get("batch_rows", BATCH_ROWS))
        self.interval_ms = int(options.get("interval_ms", INTERVAL_MS))
        self.retries = int(options.get("retries", RETRIES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Flushed:
        store, root = _store(self.path)
        files: list[str] = []

        def send(table: pa.Table) -> None:
            name = f"part-{uuid.uuid4().hex}.parquet"
            pq.write_table(table, f"{root}/{name}", filesystem=store)
            files.append(name)

        store.create_dir(root, recursive=True)
        try:
            flush_all(iterator, send, self.batch_rows, self.interval_ms, self.retries)
        except BaseException:
            self._drop(files)
            raise
        return Flushed(files)

    def _drop(self, files: list[str]) -> None:
        store, root = _store(self.path)
        for name in files:
            try:
                store.delete_file(f"{root}/{name}")
            except OSError:
                pass                                    # nothing names it, so it does not count

    def commit(self, messages: list, batchId: int) -> None:
        store, root = _store(self.path)
        files = [f for m in messages if m is not None for f in m.files]
        record = f"{root}/{_COMMITS}/{self.stream}-{batchId}.json"
        if store.get_file_info(record).type != fs.FileType.NotFound:
            self._drop(files)                           # this batch was committed before
            return
        store.create_dir(f"{root}/{_COMMITS}", recursive=True)
        hidden = f"{root}/{_COMMITS}/.{uuid.uuid4().hex}"
        with store.open_output_stream(hidden) as out:
            out.write(json.dumps(files).encode())
        store.move(hidden, record)

    def abort(self, messages: list, batchId: int) -> None:
        self._drop([f for m in messages if m is not None for f in m.files])


class FlushSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def streamWriter(self, schema: StructType, overwrite: bool) -> FlushWriter:
        return FlushWriter(dict(self.options))


def start_flush(df: DataFrame, path: str, checkpoint: str, stream: str = "stream", batch_rows: int = BATCH_ROWS,
                interval_ms: int = INTERVAL_MS, retries: int = RETRIES, trigger: dict | None = None) -> StreamingQuery:
    """Write a stream through the flushing sink."""
    df.sparkSession.dataSource.register(FlushSink)
    writer = df.writeStream.format(NAME).option("path", path).option("stream", stream).option("checkpointLocation", checkpoint)
    for name, value in (("batch_rows", batch_rows), ("interval_ms", interval_ms), ("retries", retries)):
        writer = writer.option(name, str(value))
    return writer.outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


def read_flushed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all committed batches."""
    files, root = Files(spark), path.rstrip("/")
    names = [n for n in files.names(f"{root}/{_COMMITS}") if n.endswith(".json") and not n.startswith(".")]
    parts = [f"{root}/{f}" for n in sorted(names) for f in json.loads(files.read(f"{root}/{_COMMITS}/{n}"))]
    return spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)
