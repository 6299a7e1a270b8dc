import datetime as dt
import os
from pathlib import Path


from candlewick.functions.time import month_key, time_range, yyyymm
from candlewick.operators.parse import parse_klines
from candlewick.operators.tables import to_kline_data
from candlewick.schemas import LAYOUTS
from candlewick.sources.warehouse import Warehouse, read_table, write_table
from conftest import kline_message

B = 1752397260000


def test_month_key_and_time_range(spark):
    assert month_key("2024-07-01") == 202407
    df = spark.createDataFrame([(dt.datetime(2024, 6, 30, 23, 59, 59), 202406), (dt.datetime(2024, 7, 1), 202407),
                                (dt.datetime(2024, 8, 31, 23, 59, 59), 202408), (dt.datetime(2024, 9, 1), 202409)],
                               "ts timestamp, month int")
    assert [r[0] for r in df.select(yyyymm("ts")).collect()] == [202406, 202407, 202408, 202409]
    kept = df.where(time_range("ts", "2024-07-01", "2024-09-01")).collect()
    assert [r.month for r in kept] == [202407, 202408]


def test_write_month_partitioned_sorted(spark, fresh_dir):
    msgs = [kline_message(s, B + 86400000 * 40 * i + 59999, float(i), first=i) for i in range(6) for s in ("B", "A")]
    kd = to_kline_data(parse_klines(spark.createDataFrame([(m,) for m in msgs], "value string")))
    path = os.path.join(fresh_dir, "kline_data")
    write_table(kd, path, LAYOUTS["kline_data"], "overwrite", load="one")
    months = sorted(d for d in os.listdir(os.path.join(path, "load=one")) if d.startswith("month="))
    assert months == ["month=202507", "month=202508", "month=202510", "month=202511", "month=202512", "month=202601"]
    back = read_table(spark, path, LAYOUTS["kline_data"])
    assert back.count() == 12 and "month" in back.columns
    # rows inside every file are in (symbol, interval, open_time) order
    for m in months:
        part = spark.read.parquet(os.path.join(path, "load=one", m)).collect()
        keys = [(r.symbol, r.interval, r.open_time) for r in part]
        assert keys == sorted(keys)


def test_create_if_missing_is_idempotent(spark, fresh_dir):
    wh = Warehouse(spark, fresh_dir)
    wh.create_if_missing()
    wh.create_if_missing()
    for name in LAYOUTS:
        assert wh.exists(name)
        assert wh.table(name).count() == 0


def test_partition_pruning_in_plan(spark, fresh_dir):
    from candlewick.operators.analytics import count_between
    msgs = [kline_message("A", B + 86400000 * 40 * i + 59999, 1.0, first=i) for i in range(4)]
    kd = to_kline_data(parse_klines(spark.createDataFrame([(m,) for m in msgs], "value string")))
    path = os.path.join(fresh_dir, "kd")
    write_table(kd, path, LAYOUTS["kline_data"], "overwrite")
    q = count_between(read_table(spark, path, LAYOUTS["kline_data"]), "2025-08-01", "2025-09-01")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan or "month#" in plan.split("PartitionFilters")[1][:200]
    assert q.collect()[0].n == 1


def test_scale_conf():
    from candlewick.session import scale_conf
    small = scale_conf(10 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    big = scale_conf(100 * (1 << 40), 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (256 << 20)
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    assert big["spark.sql.streaming.stateStore.providerClass"].endswith("RocksDBStateStoreProvider")


def test_compact_rewrites_only_the_chosen_months(spark, fresh_dir):
    wh = Warehouse(spark, fresh_dir)
    def batch(i, month_offset):
        msgs = [kline_message(s, B + 86400000 * 40 * month_offset + 59999 + 1000 * i, float(i), first=i)
                for s in ("B", "A")]
        return to_kline_data(parse_klines(spark.createDataFrame([(m,) for m in msgs], "value string")))
    for i in range(4):   # four small appends into July, one into August
        wh.write("kline_data", batch(i, 0), "append", clustered=False)
    wh.write("kline_data", batch(9, 1), "append", clustered=False)
    def files(month):
        return sorted(str(f) for f in Path(fresh_dir, "kline_data").glob(f"load=*/month={month}/*.parquet"))
    aug_files = files(202508)
    before = sorted(tuple(r) for r in wh.table("kline_data").collect())
    assert len(files(202507)) >= 4
    wh.compact("kline_data", [202507])
    assert sorted(tuple(r) for r in wh.table("kline_data").collect()) == before
    assert len(files(202507)) == 1
    rows = spark.read.parquet(files(202507)[0]).collect()
    keys = [(r.symbol, r.interval, r.open_time) for r in rows]
    assert keys == sorted(keys)
    assert files(202508) == aug_files


def test_hot_identical_key_is_split_on_write(spark, fresh_dir):
    """Many exact copies of one message: the clustered write spreads them over several tasks (files)."""
    msg = kline_message("HOT", B + 59999, 1.0)
    df = spark.createDataFrame([(msg,)] * 4000, "value string").repartition(8)
    kd = to_kline_data(parse_klines(df))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "1k")
    try:
        path = os.path.join(fresh_dir, "kd")
        write_table(kd, path, LAYOUTS["kline_data"], "overwrite", load="one")
    finally:
        spark.conf.set(key, old)
    files = [f for f in os.listdir(os.path.join(path, "load=one", "month=202507")) if f.endswith(".parquet")]
    assert len(files) >= 2    # one hot key, several writing tasks
    assert read_table(spark, path, LAYOUTS["kline_data"]).count() == 4000


def test_offset_bounds_read_the_right_month(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-06-30 23:00:00' AS ts, 202406 AS month")
    for month in ("month", None):
        assert df.where(time_range("ts", "2024-07-01T00:00:00+02:00", "2024-07-02", month)).count() == 1
        assert df.where(time_range("ts", "2024-07-01T00:00:00", "2024-07-02", month)).count() == 0


def test_file_ranges_do_not_sort_all_rows(spark, fresh_dir):
    """Least and greatest of each file, null keys and times among them; no sort of the rows that are read."""
    from candlewick.sources.warehouse import file_ranges
    layout = LAYOUTS["kline_events"]
    t0 = dt.datetime(2025, 7, 1)
    files = [[("A", 3), ("B", 1), ("B", None), (None, 9)], [("C", 5)], [(None, 2), (None, None)]]
    for k, items in enumerate(files):
        rows = [("kline", None if at is None else t0 + dt.timedelta(hours=at), s) for s, at in items]
        spark.createDataFrame(rows, layout.stored).coalesce(1).write.parquet(os.path.join(fresh_dir, "load=x", f"month={k}"))
    found = file_ranges(spark, os.path.join(fresh_dir, "load=x"), layout)
    hours = {None: None, **{t0 + dt.timedelta(hours=h): h for h in range(24)}}
    assert {r.file.split("/")[0]: (r.rows, r.k_lo, r.k_hi, hours[r.t_lo], hours[r.t_hi]) for r in found.collect()} == {
        "month=0": (4, "A", "B", 1, 9), "month=1": (1, "C", "C", 5, 5), "month=2": (2, None, None, 2, 2)}
    plan = found._jdf.queryExecution().sparkPlan().toString().strip().splitlines()
    first = [line for line in plan if "Aggregate(" in line][-1]      # the step next to the scan
    assert "HashAggregate(" in first and "ObjectHashAggregate(" not in first


def test_tables_are_compacted_side_by_side(spark, fresh_dir, monkeypatch):
    """Each table's compaction starts before another has ended; every table ends as one load with its rows."""
    import threading
    wh = Warehouse(spark, fresh_dir)
    msgs = [kline_message(s, B + 59999 + i, float(i), first=i) for i in range(3) for s in ("B", "A")]
    kd = to_kline_data(parse_klines(spark.createDataFrame([(m,) for m in msgs], "value string")))
    events = kd.select(kd.interval.alias("event_type"), "event_time", "symbol")
    for name, df in (("kline_data", kd), ("kline_events", events)) * 2:
        wh.write(name, df)
    before = {n: sorted(tuple(r) for r in wh.table(n).collect()) for n in ("kline_data", "kline_events")}
    meet, compact = threading.Barrier(2, timeout=60), Warehouse.compact
    monkeypatch.setattr(Warehouse, "compact", lambda self, name: (meet.wait(), compact(self, name))[1])
    wh.compact_all(("kline_data", "kline_events"))
    for name, rows in before.items():
        assert sorted(tuple(r) for r in wh.table(name).collect()) == rows and len(rows) == 12
        assert len(wh.loads(name).state().live) == 1
