"""The job entry points, run in-process on the test session."""

import os

from candlewick.cli import main
from candlewick.sources.fixtures import message_files
from conftest import SMOKE_DIR


def test_build_query_compact_stream(spark, fresh_dir):
    msgs = message_files(spark, SMOKE_DIR)
    wh = os.path.join(fresh_dir, "wh")
    assert main(["build", "--messages", msgs, "--warehouse", wh], spark) == 0
    out = os.path.join(fresh_dir, "q2")
    main(["query", "--warehouse", wh, "--name", "avg_volume_by_class", "--out", out], spark)
    assert spark.read.parquet(out).count() == 5     # asset class is the default for every symbol here
    out = os.path.join(fresh_dir, "q4")
    main(["query", "--warehouse", wh, "--name", "count_between", "--lo", "2024-01-08", "--hi", "2024-01-15",
          "--out", out], spark)
    assert spark.read.parquet(out).collect()[0].n > 0
    main(["compact", "--warehouse", wh, "--table", "kline_data"], spark)
    assert spark.read.parquet(os.path.join(wh, "kline_data")).count() == 960
    swh = os.path.join(fresh_dir, "swh")
    main(["stream", "--messages", msgs, "--warehouse", swh, "--checkpoint", os.path.join(fresh_dir, "ck"),
          "--available-now"], spark)
    assert spark.read.parquet(os.path.join(swh, "kline_events")).count() == 960


def test_vacuum_relay_flush_and_catalogue(spark, fresh_dir):
    from candlewick.schemas import KLINE_DATA
    from candlewick.sources.flush import read_flushed
    from candlewick.sources.warehouse import Warehouse
    msgs, wh = message_files(spark, SMOKE_DIR), os.path.join(fresh_dir, "wh")
    main(["--database", "market_cli_test", "build", "--messages", msgs, "--warehouse", wh], spark)
    main(["--database", "market_cli_test", "build", "--messages", msgs, "--warehouse", wh, "--add"], spark)
    assert spark.table("market_cli_test.kline_data").count() == 2 * 960
    main(["compact", "--warehouse", wh, "--table", "kline_data", "--keep-replaced"], spark)
    folders = lambda: [n for n in os.listdir(os.path.join(wh, "kline_data")) if n.startswith("load=")]
    assert len(folders()) == 3
    main(["vacuum", "--warehouse", wh, "--table", "kline_data"], spark)
    assert len(folders()) == 1 and Warehouse(spark, wh).table("kline_data").count() == 2 * 960
    out, flushed = os.path.join(fresh_dir, "relay"), os.path.join(fresh_dir, "flushed")
    main(["relay", "--messages", msgs, "--out", out, "--checkpoint", os.path.join(fresh_dir, "ck1"), "--partitions", "3"], spark)
    assert spark.read.json(out).count() == 1000
    main(["flush", "--messages", msgs, "--out", flushed, "--checkpoint", os.path.join(fresh_dir, "ck2"), "--batch-rows", "100"], spark)
    assert read_flushed(spark, flushed, KLINE_DATA).count() == 960
    assert main(["print", "--messages", msgs, "--label", "candles"], spark) == 0
