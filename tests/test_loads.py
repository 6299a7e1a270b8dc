"""The manifest of loads: readers see every row once at any moment."""

import datetime as dt
import os

import pytest

from candlewick.operators.parse import parse_klines
from candlewick.operators.tables import to_candles, to_kline_data
from candlewick.operators.windows import avg_close, close_parts
from candlewick.schemas import LAYOUTS
from candlewick.sources import loads as L
from candlewick.sources import warehouse as W
from candlewick.sources.loads import Loads, State
from candlewick.sources.warehouse import Warehouse, stream_load, write_table
from conftest import kline_message

B = 1752397260000
MONTH = 86_400_000 * 40


def rows(spark, *items):
    msgs = [kline_message(s, B + 59999 + at, c, first=i) for i, (s, at, c) in enumerate(items)]
    return parse_klines(spark.createDataFrame([(m,) for m in msgs], "value string"))


def seen(wh, name="kline_data"):
    return sorted(tuple(r) for r in wh.table(name).collect())


def test_uncommitted_files_are_not_rows(spark, fresh_dir):
    wh = Warehouse(spark, fresh_dir)
    kd = to_kline_data(rows(spark, ("A", 0, 1.0)))
    wh.write("kline_data", kd, load="one")
    for name in ("one.json", ".one.json.crc"):                                 # as if the writer had died before
        os.remove(os.path.join(fresh_dir, "kline_data", "_loads", name))
    assert seen(wh) == []
    wh.write("kline_data", kd, load="one")
    assert len(seen(wh)) == 1


def test_readers_between_the_steps_of_a_compaction(spark, fresh_dir, monkeypatch):
    """All rows once: before the commit, between commit and deletion, after it."""
    wh = Warehouse(spark, fresh_dir)
    for k in range(3):
        wh.write("kline_data", to_kline_data(rows(spark, ("A", 1000 * k, float(k)), ("B", MONTH, 2.0))), load=f"s-{k}")
    before = seen(wh)
    looks = []
    commit, vacuum = Loads.commit, Loads.vacuum
    monkeypatch.setattr(Loads, "commit", lambda self, *a, **k: (looks.append(seen(wh)), commit(self, *a, **k), looks.append(seen(wh)))[1])
    monkeypatch.setattr(Loads, "vacuum", lambda self, *a, **k: (looks.append(seen(wh)), vacuum(self, *a, **k), looks.append(seen(wh)))[1])
    assert wh.compact("kline_data", [202507])
    assert looks == [before] * 4
    assert wh.compact("kline_data") and seen(wh) == before


def test_replay_after_compaction_and_fold_adds_nothing(spark, fresh_dir):
    wh = Warehouse(spark, fresh_dir)
    parts = [to_kline_data(rows(spark, ("A", 1000 * k, float(k)))) for k in range(4)]
    names = [stream_load("/ck", k) for k in range(4)]
    for df, name in zip(parts, names):
        wh.write("kline_data", df, clustered=False, load=name)
    before = seen(wh)
    wh.compact("kline_data")
    for _ in range(2):
        for df, name in zip(parts, names):
            wh.write("kline_data", df, clustered=False, load=name)
        assert seen(wh) == before
        wh.loads("kline_data").fold()
    manifest = os.listdir(os.path.join(fresh_dir, "kline_data", "_loads"))
    assert [n for n in manifest if n.endswith(".json") and not n.startswith(".")] == ["all-2.json"]
    wh.write("kline_data", to_kline_data(rows(spark, ("A", 9000, 9.0))), load=stream_load("/ck", 4))
    assert len(seen(wh)) == 5


def test_second_compaction_of_the_same_loads_is_void(spark, fresh_dir, monkeypatch):
    wh = Warehouse(spark, fresh_dir)
    for k in range(3):
        wh.write("kline_data", to_kline_data(rows(spark, ("A", 1000 * k, float(k)))))
    before = seen(wh)
    write = W.write_table

    def overtaken(*a, **k):
        monkeypatch.setattr(W, "write_table", write)
        assert wh.compact("kline_data", keep_replaced=True)       # another job is faster
        return write(*a, **k)

    monkeypatch.setattr(W, "write_table", overtaken)
    assert not wh.compact("kline_data", keep_replaced=True)
    assert seen(wh) == before
    wh.vacuum("kline_data")
    assert seen(wh) == before
    assert len([n for n in os.listdir(os.path.join(fresh_dir, "kline_data")) if n.startswith("load=")]) == 1


def test_loads_that_arrive_during_a_compaction_stay(spark, fresh_dir, monkeypatch):
    wh = Warehouse(spark, fresh_dir)
    wh.write("kline_data", to_kline_data(rows(spark, ("A", 0, 1.0))))
    write = W.write_table

    def late(*a, **k):
        monkeypatch.setattr(W, "write_table", write)
        wh.write("kline_data", to_kline_data(rows(spark, ("B", 0, 2.0))))
        return write(*a, **k)

    monkeypatch.setattr(W, "write_table", late)
    assert wh.compact("kline_data")
    assert [r[0] for r in seen(wh)] == ["A", "B"]


def test_commits_fold_by_themselves(spark, fresh_dir, monkeypatch):
    monkeypatch.setattr(L, "FOLD_AT", 4)
    wh = Warehouse(spark, fresh_dir)
    df = to_kline_data(rows(spark, ("A", 0, 1.0)))
    for k in range(11):
        write_table(df, wh.path("kline_data"), LAYOUTS["kline_data"], clustered=False, load=f"s-{k}")
    assert wh.table("kline_data").count() == 11
    names = [n for n in os.listdir(os.path.join(fresh_dir, "kline_data", "_loads")) if n.endswith(".json") and n[0] != "."]
    assert len(names) <= 5 and sum(n.startswith("all-") for n in names) == 1


def test_overwrite_replaces_all_and_only_what_was_there(spark, fresh_dir):
    wh = Warehouse(spark, fresh_dir)
    for k in range(2):
        wh.write("symbols", spark.createDataFrame([(f"S{k}", "S", "Q", "crypto", dt.date(2025, 1, 1))], LAYOUTS["symbols"].schema))
    wh.write("symbols", spark.createDataFrame([("N", "S", "Q", "crypto", dt.date(2025, 1, 1))], LAYOUTS["symbols"].schema), "overwrite")
    assert [r[0] for r in seen(wh, "symbols")] == ["N"]
    assert len([n for n in os.listdir(os.path.join(fresh_dir, "symbols")) if n.startswith("load=")]) == 1


def record(load, months, replaces=(), at=0):
    return {"load": load, "at": at, "months": months, "replaces": replaces if replaces == "*" else list(replaces)}


def test_state_rules():
    s = State()
    for r in (record("a", [1, 2]), record("b", [2]), record("c", [2], [("a", 2), ("b", 2)])):
        s.apply(r)
    assert s.live == {"a": [1], "c": [2]} and s.partial == {"a"}
    s.apply(record("d", [2], [("b", 2)]))                 # b was replaced before: void
    s.apply(record("b", [2]))                             # and stays replaced
    assert s.live == {"a": [1], "c": [2]} and s.known("d") and s.known("b")
    s.apply(record("e", [], []))
    s.apply(record("f", [3], "*"))
    assert s.live == {"f": [3]} and s.known("e")
    s.done["x"] = 4
    assert s.known("x-3") and not s.known("x-5")


def test_a_split_window_has_one_average(spark, fresh_dir):
    items = [("A", 0, 1.0), ("A", 0, 2.0), ("B", 0, 5.0), ("A", 0, 6.0), ("A", 60_000, 7.0)]
    wh = Warehouse(spark, fresh_dir)
    for part in (items[:2], items[2:4], items[4:]):
        wh.write("kline_agg", close_parts(to_candles(rows(spark, *part))), merged=True)
    want = sorted(tuple(r) for r in avg_close(to_candles(rows(spark, *items))).collect())
    assert seen(wh, "kline_agg") == want
    assert wh.compact("kline_agg")
    assert seen(wh, "kline_agg") == want
    plan = wh.table("kline_agg")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan                        # one compacted load: a plain scan


def test_add_messages_keeps_symbols_single(spark, fresh_dir):
    from candlewick.plans.ingest import add_messages, build_warehouse
    wh = Warehouse(spark, fresh_dir)
    first = spark.createDataFrame([(kline_message("ETHBTC", B + 59999, 1.0),)], "value string")
    more = spark.createDataFrame([(kline_message("ETHBTC", B + 59999, 3.0),), (kline_message("XBTC", B + 59999, 1.0),)], "value string")
    build_warehouse(first, wh, launched="2025-07-13")
    add_messages(more, wh, launched="2025-07-13")
    assert [r.symbol for r in wh.table("symbols").orderBy("symbol").collect()] == ["ETHBTC", "XBTC"]
    assert wh.table("kline_data").count() == 3
    assert {r.symbol: r.avg_close for r in wh.table("kline_agg").collect()} == {"ETHBTC": 2.0, "XBTC": 1.0}
    build_warehouse(first, wh, launched="2025-07-13")
    assert wh.table("kline_data").count() == 1


@pytest.mark.parametrize("name", sorted(LAYOUTS))
def test_compacting_an_empty_table(spark, fresh_dir, name):
    wh = Warehouse(spark, fresh_dir)
    wh.create_if_missing()
    assert wh.compact(name) and wh.table(name).count() == 0


def test_catalogue_follows_the_manifest(spark, fresh_dir):
    wh = Warehouse(spark, fresh_dir, "market_loads_test")
    wh.create_if_missing()
    wh.create_if_missing()
    table = lambda n: spark.table(f"market_loads_test.{n}")
    assert table("kline_data").count() == 0 and table("kline_agg").count() == 0
    items = [("A", 0, 1.0), ("A", 0, 3.0), ("B", MONTH, 5.0)]
    for part in (items[:1], items[1:]):
        wh.write("kline_data", to_kline_data(rows(spark, *part)))
        wh.write("kline_agg", close_parts(to_candles(rows(spark, *part))), merged=True)
    assert table("kline_data").count() == 3
    assert sorted((r.symbol, r.avg_close) for r in table("kline_agg").collect()) == [("A", 2.0), ("B", 5.0)]
    wh.compact("kline_data", [202507])
    wh.compact("kline_agg")
    assert table("kline_data").count() == 3 and table("kline_data").select("load").distinct().count() == 2
    assert sorted((r.symbol, r.avg_close) for r in table("kline_agg").collect()) == [("A", 2.0), ("B", 5.0)]
    plan = table("kline_data").where("month = 202507")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_lookup_reads_only_files_that_can_hold_the_symbol(spark, fresh_dir):
    wh = Warehouse(spark, fresh_dir)
    items = [(f"S{k:02d}", 1000 * i, float(i)) for k in range(12) for i in range(20)] + [("S05", MONTH, 1.0)]
    wh.write("kline_data", to_kline_data(rows(spark, *items)))
    # As many files as shuffle partitions, as at scale: AQE would merge these few rows into one.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert wh.compact("kline_data")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    wh.write("kline_data", to_kline_data(rows(spark, ("S05", 5000, 9.0), ("S99", 0, 1.0))))      # a load without ranges
    table = wh.table("kline_data")
    for args, cond in ((("S05",), "symbol = 'S05'"), (("S05", "2025-07-13T09:01:00", "2025-07-13T09:01:10"),
                       "symbol = 'S05' and open_time >= timestamp'2025-07-13 09:01:00' and open_time < timestamp'2025-07-13 09:01:10'"),
                       (("nobody",), "false")):
        got = wh.lookup("kline_data", *args)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, table.where(cond).collect()))
    whole, few = len(table.inputFiles()), len(wh.lookup("kline_data", "S05").inputFiles())
    assert few < whole / 2
