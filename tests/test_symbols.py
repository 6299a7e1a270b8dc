from hypothesis import given, settings
from hypothesis import strategies as st

from candlewick.functions.symbols import base_asset, parse_symbol, quote_asset
from candlewick.schemas import KNOWN_QUOTES


def parts(spark, symbols):
    df = spark.createDataFrame([(s,) for s in symbols], "symbol string")
    return {r.symbol: (r.b, r.q) for r in df.select("symbol", base_asset("symbol").alias("b"),
                                                     quote_asset("symbol").alias("q")).collect()}


def test_cases(spark):
    got = parts(spark, ["BNBBTC", "BTC", "bnbbtc", "XRPEUR", "ETHUSDT", "XTUSD", "AUSDC", "BTCTRY", "BNBBUSD", "XBNB"])
    assert got == {
        "BNBBTC": ("BNB", "BTC"), "BTC": ("", "BTC"), "bnbbtc": ("bnbbtc", "UNKNOWN"),
        "XRPEUR": ("XRPEUR", "UNKNOWN"), "ETHUSDT": ("ETH", "USDT"), "XTUSD": ("X", "TUSD"),
        "AUSDC": ("A", "USDC"), "BTCTRY": ("BTC", "TRY"), "BNBBUSD": ("BNB", "BUSD"), "XBNB": ("X", "BNB"),
    }


def test_struct_form(spark):
    r = spark.createDataFrame([("ETHBTC",)], "symbol string").select(parse_symbol("symbol").alias("p")).collect()[0]
    assert (r.p.base_asset, r.p.quote_asset) == ("ETH", "BTC")


def test_no_quote_is_a_suffix_of_another():
    for a in KNOWN_QUOTES:
        for b in KNOWN_QUOTES:
            assert a == b or not a.endswith(b)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="ABCDEFGHIJKLMNOPQRSTUVWXYZ", max_size=6),
                          st.sampled_from(KNOWN_QUOTES + ("", "EUR", "usdt"))), min_size=1, max_size=20))
def test_property_base_plus_quote(spark, pairs):
    symbols = sorted({b + q for b, q in pairs})
    got = parts(spark, symbols)
    for s in symbols:
        base, quote = got[s]
        if quote == "UNKNOWN":
            assert base == s and not any(s.endswith(q) for q in KNOWN_QUOTES)
        else:
            assert base + quote == s and quote in KNOWN_QUOTES
