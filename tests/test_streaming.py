"""Structured Streaming behaviour on the micro-batch fixture of FIXTURES.md §6."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from candlewick.schemas import KLINE_AGG, SYMBOLS
from candlewick.sources.messages import stream_messages
from candlewick.sources.warehouse import Warehouse
from candlewick.streaming.aggregate import start_kline_agg
from candlewick.streaming.dedupe import start_symbols
from candlewick.streaming.fanout import await_all, start_fanout
from candlewick.streaming.relay import relay_records, start_relay_to_files
from conftest import CONTROL, kline_message

B = 1752397260000   # 2025-07-13 09:01:00 UTC
FILES = [
    [("A", B + 59999, 1.0), ("B", B + 59999, 2.0)],
    [("A", B + 59999, 3.0)],
    [("A", B + 119999, 5.0)],
    [("B", B + 59999, 100.0), ("B", B + 119999, 4.0)],
]
W0901 = dt.datetime(2025, 7, 13, 9, 1)


def write_files(folder, batches, start=0):
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(batches, start):
        path = os.path.join(folder, f"batch-{i:03d}.txt")
        with open(path, "w") as fh:
            for sym, close_ms, close in rows:
                fh.write(kline_message(sym, close_ms, close) + "\n")
            fh.write(CONTROL + "\n")
        t = 1_700_000_000 + 10 * i
        os.utime(path, (t, t))


def run_agg(spark, root, strict):
    src = os.path.join(root, "in")
    write_files(src, FILES)
    msgs = stream_messages(spark, src, max_files_per_trigger=1)
    q = start_kline_agg(msgs, os.path.join(root, "out"), os.path.join(root, "ck"), strict=strict)
    q.awaitTermination()
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress if p.get("stateOperators"))
    out = {(r.symbol, r.window_start): r.avg_close
           for r in spark.read.schema(KLINE_AGG).parquet(os.path.join(root, "out")).collect()}
    return out, dropped


def test_lenient_lateness_default(spark, fresh_dir):
    out, dropped = run_agg(spark, fresh_dir, strict=False)
    assert out == {("A", W0901): 2.0, ("B", W0901): 51.0}    # 09:02 still open: withheld
    assert dropped == 0


def test_strict_lateness_drops_late_row(spark, fresh_dir):
    out, dropped = run_agg(spark, fresh_dir, strict=True)
    assert out == {("A", W0901): 2.0, ("B", W0901): 2.0}
    assert dropped == 1
    # the session setting is restored afterwards
    assert spark.conf.get("spark.sql.streaming.statefulOperator.allowMultiple", "true") == "true"


@pytest.mark.parametrize("method", ["merge", "state"])
def test_dedupe_across_batches_and_restart(spark, fresh_dir, method):
    src, out, ck = (os.path.join(fresh_dir, n) for n in ("in", "out", "ck"))
    write_files(src, FILES)
    q = start_symbols(stream_messages(spark, src, 1), out, ck, launched="2025-07-13", method=method)
    q.awaitTermination()
    first = sorted(r.symbol for r in spark.read.schema(SYMBOLS).parquet(out).collect())
    assert first == ["A", "B"]
    write_files(src, [[("A", B + 179999, 1.0), ("CBTC", B + 179999, 1.0)]], start=10)
    q = start_symbols(stream_messages(spark, src, 1), out, ck, launched="2025-07-13", method=method)
    q.awaitTermination()
    rows = spark.read.schema(SYMBOLS).parquet(out).collect()
    assert sorted(r.symbol for r in rows) == ["A", "B", "CBTC"]
    c = [r for r in rows if r.symbol == "CBTC"][0]
    assert (c.base_asset, c.quote_asset, c.launched) == ("C", "BTC", dt.date(2025, 7, 13))


def test_merge_dedupe_replay_appends_nothing(spark, fresh_dir):
    """Re-running a batch (as after a failure) finds its symbols stored already."""
    from candlewick.streaming.dedupe import _merge_writer
    out = os.path.join(fresh_dir, "out")
    os.makedirs(out)
    batch = spark.createDataFrame([(kline_message("ETHBTC", B + 59999, 1.0),)] * 3, "value string")
    writer = _merge_writer(out, "2025-07-13", None, "strict")
    writer(batch, 0)
    writer(batch, 0)
    assert [r.symbol for r in spark.read.schema(SYMBOLS).parquet(out).collect()] == ["ETHBTC"]


def test_fanout_row_counts(spark, fresh_dir):
    src = os.path.join(fresh_dir, "in")
    write_files(src, FILES)
    wh = Warehouse(spark, os.path.join(fresh_dir, "wh"))
    queries = start_fanout(stream_messages(spark, src, 1), wh, os.path.join(fresh_dir, "ck"), launched="2025-07-13")
    await_all(queries)
    counts = {n: wh.table(n).count() for n in ("kline_data", "kline_events", "symbols", "kline_agg")}
    assert counts == {"kline_data": 6, "kline_events": 6, "symbols": 2, "kline_agg": 2}
    # one load for every micro-batch, month folders inside
    loads = [d for d in os.listdir(os.path.join(fresh_dir, "wh", "kline_data")) if d.startswith("load=")]
    assert len(loads) == 4
    assert os.path.isdir(os.path.join(fresh_dir, "wh", "kline_data", loads[0], "month=202507"))


def test_replayed_batch_changes_nothing(spark, fresh_dir):
    from candlewick.streaming.fanout import _stateless_writer
    wh = Warehouse(spark, fresh_dir)
    wh.create_if_missing()
    write = _stateless_writer(wh, "permissive", "/ck", "2025-07-13", None)
    bad = kline_message("A", B + 179999, 1.0).replace('"c":"1.00000000"', '"c":"x"')
    batch = spark.createDataFrame([(kline_message("A", B + 59999, 1.0),), (bad,)], "value string")
    for _ in range(2):
        write(batch, 7)
    assert {n: wh.table(n).count() for n in ("kline_data", "kline_events", "symbols")} == {
        "kline_data": 1, "kline_events": 1, "symbols": 1}
    assert [r.value for r in wh.rejects().collect()] == [bad]


def test_batch_equals_stream_on_closed_windows(spark, fresh_dir):
    from candlewick.operators.parse import parse_klines
    from candlewick.operators.tables import to_candles
    from candlewick.operators.windows import avg_close
    batches = [[("A", B + 59999 + 60000 * i, float(i)), ("B", B + 59999 + 60000 * i, 2.0 * i)] for i in range(6)]
    src = os.path.join(fresh_dir, "in")
    write_files(src, batches)
    q = start_kline_agg(stream_messages(spark, src, 2), os.path.join(fresh_dir, "out"), os.path.join(fresh_dir, "ck"))
    q.awaitTermination()
    streamed = {tuple(r) for r in spark.read.schema(KLINE_AGG).parquet(os.path.join(fresh_dir, "out")).collect()}
    batch = {tuple(r) for r in avg_close(to_candles(parse_klines(spark.read.text(src)))).collect()}
    last = max(r[1] for r in batch)
    assert streamed == {r for r in batch if r[1] < last}


def test_relay(spark, fresh_dir):
    msgs = spark.createDataFrame([(kline_message("ETHBTC", B, 1.0),), (CONTROL,), ("",), ("{broken",),
                                  ("[1,2]",), ("null",), ('{"s":"A"} junk',), ('{"s":"A"}{"s":"B"}',),
                                  ('{"s":"A"},{"s":"B"}',), ('{"s":"A"}]',), ('{"s":"A"}}',), ('{"s":"A"}] {}',)],
                                 "value string")
    got = sorted(((r.key, r.value) for r in relay_records(msgs).collect()), key=repr)
    assert got == sorted([("ETHBTC", kline_message("ETHBTC", B, 1.0)), (None, CONTROL), (None, "null")], key=repr)
    src = os.path.join(fresh_dir, "in")
    write_files(src, FILES[:1])
    q = start_relay_to_files(stream_messages(spark, src), os.path.join(fresh_dir, "out"), os.path.join(fresh_dir, "ck"))
    q.awaitTermination()
    out = spark.read.schema("key string, value string").json(os.path.join(fresh_dir, "out"))
    assert sorted((r.key or "") for r in out.collect()) == ["", "A", "B"]


def test_windowed_average_survives_restart(spark, fresh_dir):
    """Stop after part of the input, restart from the checkpoint: same windows as one run."""
    batches = [[("A", B + 59999 + 60000 * i, float(i)), ("B", B + 59999 + 60000 * i, 1.0 + i)] for i in range(6)]
    one = os.path.join(fresh_dir, "one")
    write_files(os.path.join(one, "in"), batches)
    q = start_kline_agg(stream_messages(spark, os.path.join(one, "in"), 1), os.path.join(one, "out"),
                        os.path.join(one, "ck"))
    q.awaitTermination()
    expected = {tuple(r) for r in spark.read.schema(KLINE_AGG).parquet(os.path.join(one, "out")).collect()}

    two = os.path.join(fresh_dir, "two")
    src = os.path.join(two, "in")
    write_files(src, batches[:3])
    for part in (0, 1):
        if part == 1:
            write_files(src, batches[3:], start=3)
        q = start_kline_agg(stream_messages(spark, src, 1), os.path.join(two, "out"), os.path.join(two, "ck"))
        q.awaitTermination()
    got = {tuple(r) for r in spark.read.schema(KLINE_AGG).parquet(os.path.join(two, "out")).collect()}
    assert got == expected and len(got) == 10


def test_backfill_in_bounded_batches(spark, fresh_dir):
    from candlewick.plans.ingest import backfill_warehouse
    batches = [[("A", B + 59999 + 60000 * i, float(i)), ("XBTC", B + 59999 + 60000 * i, 1.0)] for i in range(5)]
    src = os.path.join(fresh_dir, "in")
    write_files(src, batches)
    wh = Warehouse(spark, os.path.join(fresh_dir, "wh"))
    backfill_warehouse(spark, src, wh, os.path.join(fresh_dir, "ck"), max_files_per_trigger=2, launched="2025-07-13")
    assert wh.table("kline_data").count() == 10
    assert sorted(r.symbol for r in wh.table("symbols").collect()) == ["A", "XBTC"]
    assert wh.table("kline_agg").count() == 8    # the last minute of each symbol is still open


def test_known_symbols_leave_no_files(spark, fresh_dir):
    from candlewick.streaming.dedupe import _merge_writer
    out = os.path.join(fresh_dir, "out")
    os.makedirs(out)
    batch = spark.createDataFrame([(kline_message("ETHBTC", B + 59999, 1.0),)], "value string")
    writer = _merge_writer(out, "2025-07-13", None, "strict")
    writer(batch, 0)
    files = sorted(os.listdir(out))
    for k in range(1, 6):
        writer(batch, k)
    assert sorted(os.listdir(out)) == files


def test_fanout_permissive_with_a_bad_message(spark, fresh_dir):
    src = os.path.join(fresh_dir, "in")
    write_files(src, FILES)
    with open(os.path.join(src, "batch-009.txt"), "w") as fh:
        fh.write(kline_message("A", B + 179999, 1.0).replace('"c":"1.00000000"', '"c":"x"') + "\n")
    wh = Warehouse(spark, os.path.join(fresh_dir, "wh"))
    await_all(start_fanout(stream_messages(spark, src, 1), wh, os.path.join(fresh_dir, "ck"), mode="permissive",
                           launched="2025-07-13"))
    counts = {n: wh.table(n).count() for n in ("kline_data", "kline_events", "symbols", "kline_agg")}
    assert counts == {"kline_data": 6, "kline_events": 6, "symbols": 2, "kline_agg": 2}


def test_slices_of_one_row_group_are_spread(spark, fresh_dir):
    """One row group is read by one task; what is rendered and parsed of it is dealt to all, with the same messages."""
    from candlewick.plans.streams import _slice
    rows = spark.range(500).select(
        "id", (F.lit("2024-01-09 00:00:00").cast("timestamp") + F.make_dt_interval(secs=F.col("id"))).alias("ts"))
    rows.select(F.col("id").alias("event_id"), "ts", F.lit(3).cast("long").alias("user_id"), F.lit("click").alias("event_type"),
                F.lit(2.5).alias("value"), F.lit('{"k":1}').alias("props")).coalesce(1).write.parquet(f"{fresh_dir}/events.parquet")
    plain, spread = (_slice(spark, fresh_dir, "2024-01-09", "2024-01-09 00:05:00", spread=s) for s in (False, True))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert plain.rdd.getNumPartitions() == 1 and spread.rdd.getNumPartitions() == parts
    assert sorted(r.value for r in spread.collect()) == sorted(r.value for r in plain.collect())
    assert plain.count() == 300
