"""Value state, windows closed by timers, late rows as data."""

import datetime as dt
import os

from candlewick.sources.messages import stream_messages
from candlewick.sources.warehouse import Warehouse, read_table
from candlewick.schemas import LAYOUTS
from candlewick.streaming.dedupe import start_symbols
from candlewick.streaming.fanout import await_all, start_fanout
from candlewick.streaming.stateful import start_closed_windows
from test_streaming import B, FILES, W0901, write_files


def test_value_state_emits_a_symbol_once_across_restarts(spark, fresh_dir):
    src, out, ck = (os.path.join(fresh_dir, n) for n in ("in", "out", "ck"))
    write_files(src, FILES)
    for _ in range(2):
        start_symbols(stream_messages(spark, src, 1), out, ck, launched="2025-07-13", method="value_state").awaitTermination()
        write_files(src, [[("A", B + 179999, 1.0), ("CBTC", B + 179999, 1.0), ("CBTC", B + 179999, 2.0)]], start=10)
    start_symbols(stream_messages(spark, src, 1), out, ck, launched="2025-07-13", method="value_state").awaitTermination()
    rows = read_table(spark, out, LAYOUTS["symbols"]).collect()
    assert sorted((r.symbol, r.base_asset, r.quote_asset) for r in rows) == [
        ("A", "A", "UNKNOWN"), ("B", "B", "UNKNOWN"), ("CBTC", "C", "BTC")]
    # The session's own state store setting is back.
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")


def test_late_rows_are_kept_apart(spark, fresh_dir):
    """File 3 brings a row of a window that closed at file 2: not in the average, but in kline_late."""
    src = os.path.join(fresh_dir, "in")
    write_files(src, [*FILES, [("A", B + 59999, 7.0), ("B", B + 179999, 1.0)]])
    wh = Warehouse(spark, os.path.join(fresh_dir, "wh"))
    start_closed_windows(stream_messages(spark, src, 1), wh, os.path.join(fresh_dir, "ck"), salts=3).awaitTermination()
    got = {(r.symbol, r.window_start): r.avg_close for r in wh.table("kline_agg").collect()}
    w0902 = W0901 + dt.timedelta(minutes=1)
    assert got == {("A", W0901): 2.0, ("B", W0901): 2.0, ("A", w0902): 5.0, ("B", w0902): 4.0}
    late = sorted((r.symbol, r.close, r.window_start) for r in wh.table("kline_late").collect())
    assert late == [("A", 7.0, W0901), ("B", 100.0, W0901)]


def test_fanout_with_late_rows(spark, fresh_dir):
    src = os.path.join(fresh_dir, "in")
    write_files(src, FILES)
    wh = Warehouse(spark, os.path.join(fresh_dir, "wh"))
    await_all(start_fanout(stream_messages(spark, src, 1), wh, os.path.join(fresh_dir, "ck"), launched="2025-07-13", keep_late=True))
    assert {n: wh.table(n).count() for n in LAYOUTS} == {
        "kline_data": 6, "kline_events": 6, "symbols": 2, "kline_agg": 2, "kline_late": 1}


def test_lateness_is_strict_by_default(spark, fresh_dir):
    src = os.path.join(fresh_dir, "in")
    write_files(src, FILES)
    wh = Warehouse(spark, os.path.join(fresh_dir, "wh"))
    await_all(start_fanout(stream_messages(spark, src, 1), wh, os.path.join(fresh_dir, "ck"), launched="2025-07-13"))
    assert {(r.symbol, r.avg_close) for r in wh.table("kline_agg").collect()} == {("A", 2.0), ("B", 2.0)}


def test_streamed_row_frames_equal_the_batch(spark, fresh_dir):
    """A hot symbol over several batches, small chunks, a restart and a replayed batch."""
    from candlewick.operators.analytics import moving_average, price_delta
    from candlewick.operators.parse import parse_klines
    from candlewick.operators.tables import to_kline_data
    from candlewick.plans.streams import replay_last_batch
    from candlewick.streaming import rowframes as R
    batches = [[("HOT", B + 59999 + 1000 * (20 * k + i), float((7 * i + k) % 11)) for i in range(20)] + [(f"S{k}", B + 59999 + k, 1.0)]
               for k in range(3)]
    src = os.path.join(fresh_dir, "in")
    paths = [[os.path.join(fresh_dir, f"{n}{k}") for n in ("out", "ring", "ck")] for k in range(2)]
    for k, batch in enumerate(batches):
        write_files(src, [batch], start=k)
        msgs = stream_messages(spark, src, 1)
        R.start_moving_average(msgs, *paths[0], 5, chunk_rows=6).awaitTermination()
        R.start_price_delta(msgs, *paths[1], chunk_rows=6).awaitTermination()
        if k == 1:
            replay_last_batch(spark, paths[0][2])
    kd = to_kline_data(parse_klines(spark.read.text(src)))
    for path, layout, batch in ((paths[0][0], R.moving_average_layout(5), moving_average(kd, None, 5)),
                                (paths[1][0], R.PRICE_DELTA_LAYOUT, price_delta(kd))):
        got = sorted((tuple(r) for r in read_table(spark, path, layout).collect()), key=repr)
        assert got == sorted((tuple(r) for r in batch.collect()), key=repr) and len(got) == 63
    ring = read_table(spark, paths[0][1], R._RING)
    assert {(r["symbol"], r["count"]) for r in ring.groupBy("symbol").count().collect()} == {
        ("HOT", 4), ("S0", 1), ("S1", 1), ("S2", 1)}


def test_a_lagging_source_loses_no_row_and_an_idle_one_holds_nothing(spark, fresh_dir):
    from candlewick.operators.windows import average, merge_parts
    from candlewick.streaming.multisource import beat_idle, start_sources_agg
    fast, slow, out, ck = (os.path.join(fresh_dir, n) for n in ("fast", "slow", "out", "ck"))
    write_files(fast, [[("A", B + 59999, 1.0), ("A", B + 239999, 9.0)]])
    write_files(slow, [[("A", B + 59999, 3.0)]], start=1)

    def run():
        start_sources_agg([stream_messages(spark, fast), stream_messages(spark, slow)], out, ck).awaitTermination()
        parts = merge_parts(read_table(spark, out, LAYOUTS["kline_agg"]))
        return {r.window_start.minute: r.avg_close for r in parts.select("window_start", average()).collect()}

    assert run() == {}                                   # the slow source is still in 09:01
    write_files(slow, [[("A", B + 59999, 5.0), ("A", B + 119999, 7.0)]], start=2)
    write_files(fast, [[("A", B + 299999, 9.0)]], start=3)
    assert run() == {1: 3.0}                             # its late-looking row counts
    write_files(fast, [[("A", B + 359999, 9.0)]], start=4)
    assert run() == {1: 3.0}                             # now it is idle, and holds 09:02 open
    os.utime(os.path.join(fast, "batch-004.txt"), None)
    assert beat_idle(spark, [fast, slow], B + 359999, idle_s=3600) == [slow]
    write_files(fast, [[("A", B + 419999, 9.0)]], start=5)
    assert run() == {1: 3.0, 2: 7.0, 4: 9.0, 5: 9.0}


def test_balanced_relay_spreads_bytes(spark, fresh_dir):
    from pyspark.sql import functions as F
    from candlewick.streaming.relay import balanced, relay_records, start_balanced_relay
    rows = [(f'{{"s":"HOT","n":"{"x" * (k % 50)}"}}',) for k in range(3000)] + [('{"id":%d}' % k,) for k in range(1500)]
    messages = spark.createDataFrame(rows, "value string").repartition(5)
    records = relay_records(messages).persist()
    parts = balanced(records, 6).withColumn("p", F.spark_partition_id())
    sizes = [r[1] for r in parts.groupBy("p").agg(F.sum(F.octet_length("value"))).collect()]
    assert len(sizes) == 6 and max(sizes) <= 1.1 * sum(sizes) / 6
    nulls = parts.where("key is null").select("p").distinct().count()
    assert nulls >= 2                                    # messages without a key are spread
    assert sorted(parts.drop("p").collect(), key=repr) == sorted(records.collect(), key=repr)
    assert balanced(records.where("false"), 6).count() == 0
    src = os.path.join(fresh_dir, "in")
    write_files(src, FILES)
    start_balanced_relay(stream_messages(spark, src, 2), os.path.join(fresh_dir, "out"), os.path.join(fresh_dir, "ck"), 2).awaitTermination()
    out = spark.read.json(os.path.join(fresh_dir, "out"))
    assert out.where("key is not null").count() == 6 and out.select("batch").distinct().count() == 2
