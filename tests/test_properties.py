"""Property tests (hypothesis): the scalable forms equal the direct definitions."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewick.functions.time import time_range
from candlewick.operators.joins import range_join_bucketed, range_join_naive
from candlewick.operators.sequence import chunked_window

BASE = dt.datetime(2024, 1, 1)
SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

seconds = st.integers(min_value=0, max_value=90 * 86400)
candle = st.tuples(st.sampled_from("AB"), seconds, st.integers(min_value=1, max_value=40 * 86400))
event = st.tuples(st.sampled_from("AB"), seconds)


@settings(**SETTINGS)
@given(st.lists(candle, min_size=1, max_size=40), st.lists(event, min_size=1, max_size=80),
       st.lists(st.sampled_from([60, 600, 3600, 86400, 604800]), min_size=1, max_size=4, unique=True))
def test_bucketed_join_is_exact(spark, candles, events, levels):
    c = spark.createDataFrame(
        [(s, BASE + dt.timedelta(seconds=o), BASE + dt.timedelta(seconds=o + n), float(i))
         for i, (s, o, n) in enumerate(candles)],
        "symbol string, open_time timestamp, close_time timestamp, close double")
    e = spark.createDataFrame([(s, BASE + dt.timedelta(seconds=t)) for s, t in events],
                              "symbol string, event_time timestamp")
    cols = ["e.symbol", "e.event_time", "c.open_time", "c.close"]
    naive = sorted(tuple(r) for r in range_join_naive(e, c).select(*cols).collect())
    got = sorted(tuple(r) for r in range_join_bucketed(e, c, levels_s=levels).select(*cols).collect())
    assert got == naive


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from("XYZ"), st.integers(0, 20), st.integers(-50, 50)), min_size=1, max_size=120),
       st.integers(min_value=1, max_value=6), st.integers(min_value=0, max_value=4))
def test_chunked_window_is_exact(spark, rows, chunk_extra, lookback):
    df = spark.createDataFrame([(s, t, float(v), i) for i, (s, t, v) in enumerate(rows)],
                               "sym string, t int, v double, id int")
    chunk = max(lookback, 1) + chunk_extra - 1
    out = chunked_window(df, ["sym"], ["t", "id"], lookback,
                         lambda w: {"s": F.sum("v").over(w.rowsBetween(-lookback, 0)),
                                    "p": F.lag("v", 1).over(w) if lookback >= 1 else F.lit(None)},
                         chunk_rows=chunk)
    w = Window.partitionBy("sym").orderBy("t", "id")
    ref = df.select("id", F.sum("v").over(w.rowsBetween(-lookback, 0)).alias("s"),
                    (F.lag("v", 1).over(w) if lookback >= 1 else F.lit(None)).alias("p"))
    assert sorted((r.id, r.s, r.p) for r in out.collect()) == sorted((r.id, r.s, r.p) for r in ref.collect())


@settings(**SETTINGS)
@given(st.lists(st.integers(0, 800), min_size=1, max_size=60), st.integers(0, 800), st.integers(1, 400))
def test_month_pruning_predicate_is_exact(spark, days, lo, span):
    df = spark.createDataFrame([(BASE + dt.timedelta(days=d, hours=d % 24),) for d in days], "ts timestamp")
    df = df.withColumn("month", (F.year("ts") * 100 + F.month("ts")).cast("int"))
    a, b = BASE + dt.timedelta(days=lo), BASE + dt.timedelta(days=lo + span)
    with_months = df.where(time_range("ts", a, b)).count()
    plain = df.where((F.col("ts") >= F.lit(a.isoformat(" ")).cast("timestamp"))
                     & (F.col("ts") < F.lit(b.isoformat(" ")).cast("timestamp"))).count()
    assert with_months == plain


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["A", "BTC", "XETH"]), st.integers(0, 30), st.integers(1, 500)),
                min_size=1, max_size=40),
       st.integers(min_value=1, max_value=4))
def test_stream_equals_batch_on_closed_windows(spark, rows, n_files):
    """Time-ordered micro-batches, zero delay: the stream emits exactly the batch windows that closed."""
    import os
    import tempfile

    from candlewick.operators.parse import parse_klines
    from candlewick.operators.tables import to_candles
    from candlewick.operators.windows import avg_close
    from candlewick.schemas import KLINE_AGG
    from candlewick.sources.messages import stream_messages
    from candlewick.streaming.aggregate import start_kline_agg
    from conftest import kline_message

    b = 1752397260000
    events = sorted((b + 60_000 * m + 59_999, s, p / 100.0) for s, m, p in rows)
    root = tempfile.mkdtemp(prefix="candlewick-prop-")
    src = os.path.join(root, "in")
    os.makedirs(src)
    size = -(-len(events) // n_files)
    for i in range(0, len(events), size):
        path = os.path.join(src, f"f{i:05d}.txt")
        with open(path, "w") as fh:
            for close_ms, s, p in events[i:i + size]:
                fh.write(kline_message(s, close_ms, p) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    q = start_kline_agg(stream_messages(spark, src, 1), os.path.join(root, "out"), os.path.join(root, "ck"))
    q.awaitTermination()
    streamed = {(r.symbol, r.window_start, round(r.avg_close, 9))
                for r in spark.read.schema(KLINE_AGG).parquet(os.path.join(root, "out")).collect()}
    batch = avg_close(to_candles(parse_klines(spark.read.text(src))))
    max_close = dt.datetime.fromtimestamp(events[-1][0] / 1000, dt.timezone.utc).replace(tzinfo=None)
    closed = {(r.symbol, r.window_start, round(r.avg_close, 9)) for r in batch.collect()
              if r.window_start + dt.timedelta(minutes=1) <= max_close}
    assert streamed == closed
