"""Job entry points (``spark-submit -m candlewick …`` / ``python -m candlewick …``).

    stream   --messages DIR | --bootstrap HOST --topic T   --warehouse DIR --checkpoint DIR
             [--trigger-seconds N | --available-now] [--max-per-trigger N] [--keep-late | --lenient-lateness]
    build    --messages DIR --warehouse DIR [--add]         (one batch load, four tables; --add: beside what is there)
    backfill --messages DIR --warehouse DIR --checkpoint DIR [--max-per-trigger N]
    compact  --warehouse DIR --table NAME [--months 202407 202408 ...] [--keep-replaced]
    vacuum   --warehouse DIR --table NAME [--older-than SECONDS]
    query    --warehouse DIR --name NAME [--symbol S] [--lo T] [--hi T] [--asset-class C] --out DIR
    relay    --messages DIR | --bootstrap HOST --topic T   --checkpoint DIR
             --out DIR [--partitions N: parts of equal bytes] | --to-bootstrap HOST --to-topic T [--partitions N: by key]
    print    --messages DIR --label TEXT [--checkpoint DIR]  (candles on the console)
    flush    --messages DIR --out DIR --checkpoint DIR [--batch-rows N] [--interval-ms N] [--retries N]

--database NAME registers the tables of --warehouse in the catalogue.  --input-bytes and --cores size partitions
for a run (``session.scale_conf``).  The session is the one ``spark-submit`` provides (or a local one); the
checkpoint folder defaults to the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from candlewick.schemas import LAYOUTS
from candlewick.session import configure, scale_conf

QUERY_NAMES = ("all_windowed_averages", "avg_volume_by_class", "moving_average", "count_between",
               "events_in_candles", "price_delta")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="candlewick")
    p.add_argument("--database", default=None)
    p.add_argument("--input-bytes", type=int, default=None)
    p.add_argument("--cores", type=int, default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("stream", help="run the fan-out stream into the warehouse")
    s.add_argument("--messages")
    s.add_argument("--bootstrap")
    s.add_argument("--topic")
    s.add_argument("--warehouse", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--trigger-seconds", type=int, default=None)
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--max-per-trigger", type=int, default=None)
    s.add_argument("--lenient-lateness", action="store_true")
    s.add_argument("--keep-late", action="store_true")
    s.add_argument("--mode", choices=("strict", "permissive"), default="strict")

    b = sub.add_parser("build", help="batch load of message files into the four tables")
    b.add_argument("--messages", required=True)
    b.add_argument("--warehouse", required=True)
    b.add_argument("--mode", choices=("strict", "permissive"), default="strict")
    b.add_argument("--add", action="store_true")

    f = sub.add_parser("backfill", help="load message files through the stream in bounded batches")
    f.add_argument("--messages", required=True)
    f.add_argument("--warehouse", required=True)
    f.add_argument("--checkpoint", required=True)
    f.add_argument("--max-per-trigger", type=int, default=1000)
    f.add_argument("--mode", choices=("strict", "permissive"), default="strict")

    c = sub.add_parser("compact", help="re-cluster month partitions of a table")
    c.add_argument("--warehouse", required=True)
    c.add_argument("--table", required=True, choices=sorted(LAYOUTS))
    c.add_argument("--months", type=int, nargs="*", default=None)
    c.add_argument("--keep-replaced", action="store_true")

    v = sub.add_parser("vacuum", help="delete the files of replaced loads")
    v.add_argument("--warehouse", required=True)
    v.add_argument("--table", required=True, choices=sorted(LAYOUTS))
    v.add_argument("--older-than", type=float, default=0.0)

    q = sub.add_parser("query", help="run an analyst query and write its result")
    q.add_argument("--warehouse", required=True)
    q.add_argument("--name", required=True, choices=QUERY_NAMES)
    q.add_argument("--symbol", default=None)
    q.add_argument("--lo", default=None)
    q.add_argument("--hi", default=None)
    q.add_argument("--asset-class", default="crypto")
    q.add_argument("--out", required=True)

    r = sub.add_parser("relay", help="relay messages as (key, value) records")
    r.add_argument("--messages")
    r.add_argument("--bootstrap")
    r.add_argument("--topic")
    r.add_argument("--out")
    r.add_argument("--to-bootstrap")
    r.add_argument("--to-topic")
    r.add_argument("--partitions", type=int, default=None)
    r.add_argument("--checkpoint", required=True)

    d = sub.add_parser("print", help="print candles with a label")
    d.add_argument("--messages", required=True)
    d.add_argument("--label", required=True)
    d.add_argument("--checkpoint", default=None)

    f = sub.add_parser("flush", help="kline_data through the sink that flushes by number or time")
    f.add_argument("--messages", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--checkpoint", required=True)
    f.add_argument("--batch-rows", type=int, default=50_000)
    f.add_argument("--interval-ms", type=int, default=200)
    f.add_argument("--retries", type=int, default=3)
    return p


def _messages(spark: SparkSession, args) -> DataFrame:
    """The message stream that the arguments name."""
    from candlewick.sources.messages import stream_messages, stream_topic
    most = getattr(args, "max_per_trigger", None)
    if args.messages:
        return stream_messages(spark, args.messages, most)
    if args.bootstrap and args.topic:
        return stream_topic(spark, args.bootstrap, args.topic, max_offsets_per_trigger=most)
    raise SystemExit(f"{args.cmd} needs --messages or --bootstrap and --topic")


def _trigger(args) -> dict:
    if args.available_now or not args.trigger_seconds:
        return {"availableNow": True} if args.available_now else {"processingTime": "1 second"}
    return {"processingTime": f"{args.trigger_seconds} seconds"}


def run_query(spark: SparkSession, warehouse_dir: str, name: str, symbol=None, lo=None, hi=None,
              asset_class: str = "crypto") -> DataFrame:
    from candlewick.operators import analytics as A
    from candlewick.sources.warehouse import Warehouse

    wh = Warehouse(spark, warehouse_dir)
    kd = wh.table("kline_data")
    if name == "all_windowed_averages":
        return A.all_windowed_averages(wh.table("kline_agg"))
    if name == "avg_volume_by_class":
        return A.avg_volume_by_class(kd, wh.table("symbols"), asset_class)
    if name == "moving_average":
        return A.moving_average(kd, symbol)
    if name == "count_between":
        if lo is None or hi is None:
            raise SystemExit("count_between needs --lo and --hi")
        return A.count_between(kd, lo, hi)
    if name == "events_in_candles":
        return A.events_in_candles(wh.table("kline_events"), kd)
    return A.price_delta(kd, symbol)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    if spark is None:
        spark = SparkSession.builder.appName(f"candlewick-{args.cmd}").getOrCreate()
    configure(spark)
    if args.input_bytes and args.cores:
        for key, value in scale_conf(args.input_bytes, args.cores).items():
            spark.conf.set(key, value)
    from candlewick.sources.warehouse import Warehouse
    warehouse = Warehouse(spark, args.warehouse, args.database) if getattr(args, "warehouse", None) else None

    if args.cmd == "stream":
        from candlewick.streaming.fanout import await_all, start_fanout
        await_all(start_fanout(_messages(spark, args), warehouse, args.checkpoint, mode=args.mode,
                               strict_lateness=not args.lenient_lateness, trigger=_trigger(args), keep_late=args.keep_late))
    elif args.cmd == "build":
        from candlewick.plans.ingest import add_messages, build_warehouse
        from candlewick.sources.messages import read_messages
        (add_messages if args.add else build_warehouse)(read_messages(spark, args.messages), warehouse, args.mode)
    elif args.cmd == "backfill":
        from candlewick.plans.ingest import backfill_warehouse
        backfill_warehouse(spark, args.messages, warehouse, args.checkpoint, args.max_per_trigger, mode=args.mode)
    elif args.cmd == "compact":
        warehouse.compact(args.table, args.months, args.keep_replaced)
    elif args.cmd == "vacuum":
        warehouse.vacuum(args.table, args.older_than)
    elif args.cmd == "query":
        df = run_query(spark, args.warehouse, args.name, args.symbol, args.lo, args.hi, args.asset_class)
        df.write.mode("overwrite").parquet(args.out)
    elif args.cmd == "relay":
        from candlewick.streaming import relay
        messages = _messages(spark, args)
        if args.out and args.partitions:
            query = relay.start_balanced_relay(messages, args.out, args.checkpoint, args.partitions)
        elif args.out:
            query = relay.start_relay_to_files(messages, args.out, args.checkpoint)
        elif args.to_bootstrap and args.to_topic:
            query = relay.start_relay_to_topic(messages, args.to_bootstrap, args.to_topic, args.checkpoint, args.partitions)
        else:
            raise SystemExit("relay needs --out, or --to-bootstrap and --to-topic")
        query.awaitTermination()
    elif args.cmd == "print":
        from candlewick.operators.parse import parse_klines
        from candlewick.operators.tables import to_candles
        from candlewick.sources.messages import stream_messages
        from candlewick.streaming.console import candle_text, start_console
        candles = to_candles(parse_klines(stream_messages(spark, args.messages)))
        start_console(candles, args.label, candle_text(candles), {"availableNow": True}, args.checkpoint).awaitTermination()
    elif args.cmd == "flush":
        from candlewick.operators.parse import parse_klines
        from candlewick.operators.tables import to_kline_data
        from candlewick.sources.flush import start_flush
        from candlewick.sources.messages import stream_messages
        rows = to_kline_data(parse_klines(stream_messages(spark, args.messages)))
        start_flush(rows, args.out, args.checkpoint, batch_rows=args.batch_rows, interval_ms=args.interval_ms,
                    retries=args.retries).awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
