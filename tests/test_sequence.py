"""The chunked row-frame window equals the plain per-key window."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewick.operators.analytics import moving_average, price_delta
from candlewick.operators.sequence import chunked_window, number_rows


def frame(spark, n=300, symbols=("A", "B", "C"), skew=0.6, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        s = symbols[0] if rnd.random() < skew else rnd.choice(symbols)
        rows.append((s, rnd.randint(0, 40), rnd.random() * 100, i))
    return spark.createDataFrame(rows, "sym string, t int, v double, id int")


def reference(df, lookback):
    w = Window.partitionBy("sym").orderBy("t", "id")
    return df.select("sym", "t", "id", "v",
                     F.avg("v").over(w.rowsBetween(-lookback, 0)).alias("ma"),
                     F.lag("v", 1).over(w).alias("prev"))


@pytest.mark.parametrize("chunk_rows", [4, 5, 7, 64, 1 << 20])
def test_chunked_equals_plain(spark, chunk_rows):
    df = frame(spark)
    out = chunked_window(df, ["sym"], ["t", "id"], 4,
                         lambda w: {"ma": F.avg("v").over(w.rowsBetween(-4, 0)),
                                    "prev": F.lag("v", 1).over(w)},
                         chunk_rows=chunk_rows)
    got = {(r.sym, r.id): (round(r.ma, 9), r.prev) for r in out.collect()}
    exp = {(r.sym, r.id): (round(r.ma, 9), r.prev) for r in reference(df, 4).collect()}
    assert got == exp


def test_output_is_sorted(spark):
    df = frame(spark, n=120)
    out = chunked_window(df, ["sym"], ["t", "id"], 1, lambda w: {"prev": F.lag("v", 1).over(w)}, chunk_rows=5)
    keys = [(r.sym, r.t, r.id) for r in out.collect()]
    assert keys == sorted(keys)


def test_number_rows_is_dense(spark):
    df = frame(spark, n=200)
    pos = [r._pos for r in number_rows(df, ["sym", "t", "id"]).orderBy("_pos").collect()]
    assert pos == list(range(200))


def test_chunk_smaller_than_lookback_rejected(spark):
    with pytest.raises(ValueError):
        chunked_window(frame(spark, n=10), ["sym"], ["t"], 4, lambda w: {}, chunk_rows=3)


def test_moving_average_and_delta_match_python(spark):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    rows = []
    rnd = random.Random(3)
    for i in range(60):
        rows.append(("X", base + dt.timedelta(hours=i // 3), round(rnd.random() * 10, 2),
                     base + dt.timedelta(minutes=i), i, i + 1))
    rows.append(("Y", base, 1.0, base, 999, 1000))
    df = spark.createDataFrame(rows, "symbol string, open_time timestamp, close double, event_time timestamp, "
                                     "first_trade_id long, last_trade_id long")
    ma = moving_average(df, "X", 5, chunk_rows=7).collect()
    closes = [r[2] for r in rows if r[0] == "X"]
    assert [r.close for r in ma] == closes
    for i, r in enumerate(ma):
        win = closes[max(0, i - 4): i + 1]
        assert abs(r.ma5 - sum(win) / len(win)) < 1e-9
    pd = price_delta(df, "X", chunk_rows=7).collect()
    assert pd[0].prev_close is None and pd[0].price_delta is None
    for i in range(1, len(pd)):
        assert pd[i].prev_close == closes[i - 1]
        assert pd[i].price_delta == closes[i] - closes[i - 1]


def test_hot_symbol_is_spread_over_tasks(spark):
    """One symbol with most rows: its window work lands in several tasks, none holding it all.

    AQE would merge these tiny partitions back into one (it merges only up to its
    advisory size, so large partitions stay apart); coalescing is off here to see
    the split itself.
    """
    rows = [("HOT", i % 50, float(i), i) for i in range(4000)] + [("COLD", i, 1.0, 10_000 + i) for i in range(40)]
    df = spark.createDataFrame(rows, "sym string, t int, v double, id int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = chunked_window(df, ["sym"], ["t", "id"], 4,
                             lambda w: {"ma": F.avg("v").over(w.rowsBetween(-4, 0))}, chunk_rows=250)
        per_task = out.where(F.col("sym") == "HOT").groupBy(F.spark_partition_id().alias("p")).count().collect()
        exp = reference(df.withColumnRenamed("v", "v"), 4).where(F.col("sym") == "HOT")
        assert {(r.id, round(r.ma, 9)) for r in out.where(F.col("sym") == "HOT").collect()} == {
            (r.id, round(r.ma, 9)) for r in exp.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(per_task) >= 4
    assert max(r["count"] for r in per_task) <= 0.5 * 4000


def test_exact_copies_are_split_by_the_numbering_sort(spark):
    """Thousands of identical rows: the range sort spreads them over several tasks (written files)."""
    from candlewick.operators.sequence import number_rows
    df = spark.createDataFrame([("HOT", 1, 1.0)] * 3000 + [("X", 2, 2.0)] * 10, "sym string, t int, v double")
    df = df.repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = number_rows(df, ["sym", "t", "v"])
        rows = numbered.collect()
        # each small written file is its own read partition here
        hot_files = numbered.where("sym = 'HOT'").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(r._pos for r in rows) == list(range(3010))
    assert hot_files >= 2


def test_many_chunks_cost_a_bisection_a_row(spark):
    """2,000 chunks give the plain window's rows, and no list of chunk ends is searched through or carried in rows."""
    df = spark.range(12_000).select(F.lit("A").alias("sym"), (F.col("id") % 5000).cast("int").alias("t"),
                                    F.col("id").cast("double").alias("v"), F.col("id").cast("int").alias("id"))
    out = chunked_window(df, ["sym"], ["t", "id"], 4, lambda w: {"ma": F.avg("v").over(w.rowsBetween(-4, 0)),
                                                                 "prev": F.lag("v", 1).over(w)}, chunk_rows=6)
    got = {(r.id, round(r.ma, 9), r.prev) for r in out.collect()}
    assert got == {(r.id, round(r.ma, 9), r.prev) for r in reference(df, 4).collect()}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" in plan and "filter(" not in plan
    assert "AS _ends" not in plan and "AS _tails" not in plan
