"""Symbol → (base asset, quote asset), as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewick.schemas import KNOWN_QUOTES, UNKNOWN_QUOTE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quote_asset(symbol: Column | str, quotes=KNOWN_QUOTES) -> Column:
    """The listed quote that ends the symbol, else ``UNKNOWN``.

    No listed quote is a suffix of another, so at most one can match and the
    order of the checks does not matter.  Case-sensitive.
    """
    s = _col(symbol)
    expr = F.lit(UNKNOWN_QUOTE)
    for q in reversed(quotes):
        expr = F.when(s.endswith(q), F.lit(q)).otherwise(expr)
    return expr


def base_asset(symbol: Column | str, quotes=KNOWN_QUOTES) -> Column:
    """The symbol without its quote suffix; the whole symbol when none matches."""
    s = _col(symbol)
    expr = s
    for q in reversed(quotes):
        expr = F.when(s.endswith(q), s.substr(F.lit(1), F.length(s) - len(q))).otherwise(expr)
    return expr


def parse_symbol(symbol: Column | str) -> Column:
    """``struct(base_asset, quote_asset)`` of a symbol column."""
    return F.struct(base_asset(symbol).alias("base_asset"), quote_asset(symbol).alias("quote_asset"))
