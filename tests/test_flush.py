"""The flushing stream sink: by number, by time, with retries, no row lost or doubled."""

import os

import pyarrow as pa
import pytest

from candlewick.operators.parse import parse_klines
from candlewick.operators.tables import to_kline_events
from candlewick.plans.streams import replay_last_batch
from candlewick.schemas import KLINE_EVENTS
from candlewick.sources.flush import flush_all, read_flushed, retried, start_flush
from candlewick.sources.messages import stream_messages
from conftest import kline_message
from test_streaming import B, FILES, write_files


def batches(*sizes):
    at = 0
    for n in sizes:
        yield pa.RecordBatch.from_pydict({"x": list(range(at, at + n))})
        at += n


def test_flush_by_number_and_time():
    sent = []
    flush_all(batches(3, 9, 0, 1), lambda t: sent.append(t.column(0).to_pylist()), 5, 10_000, 0)
    assert sent == [[0, 1, 2, 3, 4], [5, 6, 7, 8, 9], [10, 11, 12]]
    sent.clear()
    ticks = iter(range(100))
    flush_all(batches(1, 1, 1, 1), lambda t: sent.append(t.num_rows), 100, 2_000, 0, clock=lambda: next(ticks))
    assert sum(sent) == 4 and len(sent) == 2


def test_retries():
    tries = []

    def flaky():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("not yet")

    retried(flaky, 3, 0.001)
    assert len(tries) == 3
    with pytest.raises(OSError):
        retried(lambda: (_ for _ in ()).throw(OSError("never")), 2, 0.001)


def test_stream_with_a_task_that_fails_once(spark, fresh_dir):
    src, out, ck = (os.path.join(fresh_dir, n) for n in ("in", "out", "ck"))
    marker = os.path.join(fresh_dir, "failed")
    write_files(src, FILES)

    def fail_once(parts):
        for part in parts:
            if "PILL" in part.column("symbol").to_pylist() and not os.path.exists(marker):
                open(marker, "w").close()
                raise RuntimeError("lost task")
            yield part

    def run():
        rows = to_kline_events(parse_klines(stream_messages(spark, src, 1)))
        rows = rows.mapInArrow(fail_once, KLINE_EVENTS)
        start_flush(rows, out, ck, batch_rows=2, interval_ms=60_000).awaitTermination()

    run()
    assert read_flushed(spark, out, KLINE_EVENTS).count() == 6
    with open(os.path.join(src, "batch-009.txt"), "w") as fh:
        fh.writelines(kline_message(s, B + 179999, 1.0) + "\n" for s in ("A", "B", "C", "PILL"))
    with pytest.raises(Exception, match="lost task"):
        run()
    assert read_flushed(spark, out, KLINE_EVENTS).count() == 6
    run()
    assert read_flushed(spark, out, KLINE_EVENTS).count() == 10
    replay_last_batch(spark, ck)
    run()
    rows = read_flushed(spark, out, KLINE_EVENTS)
    assert rows.count() == 10
    # Files that no record names are gone: at most two rows in each of the others.
    files = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(files) == len({f.rsplit("/", 1)[-1] for f in rows.inputFiles()})
