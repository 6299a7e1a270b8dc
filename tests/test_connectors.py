"""Topic, JDBC and console pieces: option builders and text forms (no broker or database here)."""


from candlewick.operators.parse import parse_klines
from candlewick.operators.tables import to_candles
from candlewick.sources.jdbc import jdbc_batch_writer, jdbc_options
from candlewick.sources.messages import topic_options
from candlewick.streaming.console import candle_text, labelled
from candlewick.streaming.relay import topic_sink_options
from conftest import SAMPLE


def test_topic_options():
    o = topic_options("broker:9092", "klines", min_partitions=16, max_offsets_per_trigger=1000)
    assert o == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "klines", "startingOffsets": "latest",
                 "maxOffsetsPerTrigger": "1000", "minPartitions": "16"}
    s = topic_sink_options("broker:9092", "klines", "/ck")
    assert s["topic"] == "klines" and s["checkpointLocation"] == "/ck"


def test_jdbc_options():
    o = jdbc_options("jdbc:x://host/db", "kline_agg", "u", "p", num_partitions=4)
    assert o == {"url": "jdbc:x://host/db", "dbtable": "kline_agg", "batchsize": "5", "user": "u",
                 "password": "p", "numPartitions": "4"}
    assert callable(jdbc_batch_writer(o, ["symbol", "window_start", "avg_close"]))


def test_candle_text_and_label(spark):
    c = to_candles(parse_klines(spark.createDataFrame([(SAMPLE,)], "value string")))
    line = c.select(candle_text(c).alias("t")).collect()[0].t
    assert line == "candle(BNBBTC close=0.00585 at=1752397319999 volume=5.688)"
    lab = labelled(c.select("symbol"), "Parsed").collect()[0].line
    assert lab == 'Parsed> {"symbol":"BNBBTC"}'
