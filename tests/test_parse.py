import datetime as dt

import pytest
from pyspark.errors import PySparkException

from candlewick.operators.parse import kline_rejects, parse_klines, parse_trades, trade_headers, trade_rejects
from candlewick.operators.tables import to_candles, to_kline_data, to_kline_events, to_symbols
from candlewick.operators.windows import avg_close
from conftest import CONTROL, SAMPLE, kline_message


def msgs(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_golden_kline_data(spark):
    rows = to_kline_data(parse_klines(msgs(spark, SAMPLE, CONTROL))).collect()
    assert len(rows) == 1
    r = rows[0].asDict()
    assert r == {
        "symbol": "BNBBTC", "interval": "1m",
        "open_time": dt.datetime(2025, 7, 13, 9, 1, 0), "close_time": dt.datetime(2025, 7, 13, 9, 1, 59),
        "first_trade_id": 273280640, "last_trade_id": 273280663,
        "open": 0.005851, "close": 0.00585, "high": 0.005851, "low": 0.005849, "volume": 5.688,
        "trade_count": 24, "is_closed": False, "quote_asset_volume": 0.03327391,
        "taker_buy_base_volume": 1.259, "taker_buy_quote_volume": 0.00736515,
        "event_time": dt.datetime(2025, 7, 13, 9, 1, 30),
    }


def test_golden_events_symbols_agg(spark):
    k = parse_klines(msgs(spark, SAMPLE, CONTROL))
    assert [tuple(r) for r in to_kline_events(k).collect()] == [
        ("kline", dt.datetime(2025, 7, 13, 9, 1, 30), "BNBBTC")]
    sym = to_symbols(k, "2025-07-13").collect()
    assert [tuple(r) for r in sym] == [("BNBBTC", "BNB", "BTC", "crypto", dt.date(2025, 7, 13))]
    agg = avg_close(to_candles(k)).collect()
    assert [tuple(r) for r in agg] == [("BNBBTC", dt.datetime(2025, 7, 13, 9, 1), 0.00585)]


def test_millisecond_precision_kept_when_asked(spark):
    k = parse_klines(msgs(spark, SAMPLE))
    r = to_kline_data(k, precision="milli").collect()[0]
    assert r.close_time == dt.datetime(2025, 7, 13, 9, 1, 59, 999000)
    assert r.event_time == dt.datetime(2025, 7, 13, 9, 1, 30, 16000)


def test_prefilter_is_whitespace_sensitive(spark):
    spaced = SAMPLE.replace('"e":"kline"', '"e": "kline"')
    assert parse_klines(msgs(spark, spaced)).count() == 0


def test_control_empty_and_trade_are_not_klines(spark):
    trade = '{"e":"trade","E":1,"s":"BNBBTC","t":5,"p":"1.5","q":"2","T":1,"m":true,"M":true}'
    assert parse_klines(msgs(spark, CONTROL, "", trade)).count() == 0


def test_unknown_outer_field_is_ignored(spark):
    extra = SAMPLE.replace('{"e":"kline"', '{"zz":[1,2,{"a":null}],"e":"kline"')
    assert parse_klines(msgs(spark, extra)).count() == 1


def test_strict_mode_fails_on_bad_decimal(spark):
    bad = SAMPLE.replace('"c":"0.00585000"', '"c":"abc"')
    with pytest.raises(PySparkException):
        parse_klines(msgs(spark, SAMPLE, bad)).collect()


def test_strict_mode_fails_on_broken_json(spark):
    broken = SAMPLE[:60]
    with pytest.raises(PySparkException):
        parse_klines(msgs(spark, broken)).collect()


def test_permissive_mode_routes_rejects(spark):
    bad = SAMPLE.replace('"c":"0.00585000"', '"c":"abc"')
    broken = SAMPLE[:60]
    df = msgs(spark, SAMPLE, bad, broken, CONTROL)
    assert parse_klines(df, "permissive").count() == 1
    assert sorted(r.value for r in kline_rejects(df).collect()) == sorted([bad, broken])


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        parse_klines(msgs(spark, SAMPLE), "lenient")


def test_trades(spark):
    trade = '{"e":"trade","E":1752397290016,"s":"BNBBTC","t":12,"p":"0.0058","q":"1.5","T":1752397290010,"m":true,"M":false}'
    t = parse_trades(msgs(spark, trade, SAMPLE, CONTROL)).collect()
    assert len(t) == 1 and t[0].trade_id == 12 and t[0].price == 0.0058 and t[0].buyer_is_maker is True
    assert t[0].ignore_flag is False
    h = trade_headers(msgs(spark, trade)).collect()
    assert [tuple(r) for r in h] == [("trade", dt.datetime(2025, 7, 13, 9, 1, 30, 16000), "BNBBTC")]
    bad = trade.replace('"p":"0.0058"', '"p":"x"')
    # the header view does not look at the trade body, the typed view rejects it
    assert trade_headers(msgs(spark, bad)).count() == 1
    assert trade_rejects(msgs(spark, bad)).count() == 1


def test_parse_is_one_narrow_stage(spark):
    plan = parse_klines(msgs(spark, SAMPLE))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_avg_close_on_stored_rows_and_closed_only(spark):
    from conftest import kline_message
    b = 1752397260000
    closed = kline_message("A", b + 59999, 4.0).replace('"x":false', '"x":true')
    df = msgs(spark, kline_message("A", b + 59999, 1.0), closed, kline_message("A", b + 119999, 9.0))
    kd = to_kline_data(parse_klines(df))
    all_rows = {tuple(r) for r in avg_close(kd, time_col="close_time").collect()}
    assert all_rows == {("A", dt.datetime(2025, 7, 13, 9, 1), 2.5), ("A", dt.datetime(2025, 7, 13, 9, 2), 9.0)}
    only_closed = [tuple(r) for r in avg_close(kd, time_col="close_time", closed_only=True).collect()]
    assert only_closed == [("A", dt.datetime(2025, 7, 13, 9, 1), 4.0)]


def test_symbols_launched_defaults_to_processing_date(spark):
    k = parse_klines(msgs(spark, SAMPLE))
    row = to_symbols(k).collect()[0]
    today = spark.sql("select current_date() as d").collect()[0].d
    assert row.launched == today


def test_absent_numbers_and_booleans_have_defaults(spark):
    msg = kline_message("A", 1752397319999, 1.0).replace('"n":1,', "").replace('"x":false,', "")
    row = parse_klines(spark.createDataFrame([(msg,)], "value string")).first()
    assert (row.trade_count, row.is_closed) == (0, False)
    no_close = msg.replace('"c":"1.00000000",', "")
    assert kline_rejects(spark.createDataFrame([(no_close,), (msg,)], "value string")).count() == 1
