"""Raw exchange messages → typed kline / trade columns.

The message keys differ only by case (``e``/``E``, ``t``/``T``, ``l``/``L``, ...),
which makes field *references* ambiguous under Spark's case-insensitive
resolution.  The JSON itself is parsed in one pass with ``from_json`` against the
wire schema (the parser matches keys exactly), and the resulting struct is cast
to a struct of the same shape with distinct field names: a cast renames fields
by position, so no name is ever resolved ambiguously and no session setting is
changed.  Every wire field is read as text and converted with ``try_cast``, so
numbers sent as strings (and vice versa) are accepted as the reference's JSON
mapper accepts them.  Everything here is a narrow, codegen-friendly projection:
it runs unchanged on batch and streaming DataFrames.

Error policy (``mode``):
  * ``"strict"`` – a kline/trade message that does not parse, or whose numbers do
    not convert, fails the query (as the reference job does);
  * ``"permissive"`` – such rows are dropped here and can be inspected with
    ``kline_rejects`` / ``trade_rejects``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.time import millis_to_ts
from candlewick.schemas import KLINE_MARKER, TRADE_MARKER

# Keys of the nested candle object, in wire order, and the column each becomes.
_K_FIELDS = [
    ("t", "open_time_ms", "bigint"),
    ("T", "close_time_ms", "bigint"),
    ("s", "k_symbol", "string"),
    ("i", "interval", "string"),
    ("f", "first_trade_id", "bigint"),
    ("L", "last_trade_id", "bigint"),
    ("o", "open", "double"),
    ("c", "close", "double"),
    ("h", "high", "double"),
    ("l", "low", "double"),
    ("v", "volume", "double"),
    ("n", "trade_count", "int"),
    ("x", "is_closed", "boolean"),
    ("q", "quote_asset_volume", "double"),
    ("V", "taker_buy_base_volume", "double"),
    ("Q", "taker_buy_quote_volume", "double"),
]
_TRADE_FIELDS = [
    ("t", "trade_id", "bigint"),
    ("p", "price", "double"),
    ("q", "quantity", "double"),
    ("T", "trade_time_ms", "bigint"),
    ("m", "buyer_is_maker", "boolean"),
    ("M", "ignore_flag", "boolean"),
]

KLINE_COLUMNS = ["event_type", "event_time_ms", "symbol"] + [c for _, c, _ in _K_FIELDS]
TRADE_COLUMNS = ["event_type", "event_time_ms", "symbol"] + [c for _, c, _ in _TRADE_FIELDS]

MODES = ("strict", "permissive")

# What a field that a message leaves out reads as, by type (fixed values).
ABSENT = {"bigint": 0, "int": 0, "boolean": False}


def is_kline(value: Column | str = "value") -> Column:
    """Whitespace-sensitive substring test, exactly as the reference filters."""
    v = F.col(value) if isinstance(value, str) else value
    return v.contains(KLINE_MARKER)


def is_trade(value: Column | str = "value") -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return v.contains(TRADE_MARKER)


def _wire_schema(outer: list[str], nested: list[str] | None) -> str:
    """DDL of the wire struct: every field as text, keys exactly as sent."""
    cols = [f"`{k}` string" for k in outer]
    if nested is not None:
        cols.append("`k` struct<" + ", ".join(f"`{k}`: string" for k in nested) + ">")
    return ", ".join(cols)


def _renamed_type(outer: list[str], nested: list[str] | None) -> str:
    """The same struct shape with distinct names (``_h0``.., ``_k`` with ``_k_0``..)."""
    fields = [f"{n}: string" for n in outer]
    if nested is not None:
        fields.append("_k: struct<" + ", ".join(f"{n}: string" for n in nested) + ">")
    return "struct<" + ", ".join(fields) + ">"


def _extract(df: DataFrame, value_col: str, outer_keys: list[str], outer_names: list[str],
             nested_keys: list[str] | None = None, nested_names: list[str] | None = None) -> DataFrame:
    """One ``from_json`` pass; the fields come out under the given (distinct) names."""
    parsed = F.from_json(F.col(value_col), _wire_schema(outer_keys, nested_keys))
    renamed = parsed.cast(_renamed_type(outer_names, nested_names))
    # ``inline`` of a one-element array turns the struct's fields into generator
    # outputs: later filters and projections reference them as plain columns,
    # so the optimizer cannot copy the parse into every reference.  A NULL
    # struct (unparsable text) still yields one row of NULLs.
    fields = df.select(value_col, F.inline(F.array(renamed)))
    cols = [F.col(n) for n in outer_names]
    if nested_names is not None:
        cols += [F.col(f"_k.{n}").alias(n) for n in nested_names]
    return fields.select(value_col, *cols)


def _typed(raw: DataFrame, typed: list[tuple[str, str, str]], keep: list[str]) -> DataFrame:
    """Convert the raw strings; ``_bad`` marks rows where a field does not convert or a text field is missing.

    Whole numbers and booleans that a message leaves out are 0 and false; decimals are sent as text
    and must be there.

    ``try_cast`` is used in both modes so the outcome does not depend on the
    session's ANSI setting; strict mode turns ``_bad`` into an error.
    """
    cols = []
    bad = F.lit(False)
    for raw_name, name, dtype in typed:
        conv = F.col(raw_name) if dtype == "string" else F.col(raw_name).try_cast(dtype)
        if dtype in ABSENT:
            conv = F.when(F.col(raw_name).isNull(), F.lit(ABSENT[dtype]).cast(dtype)).otherwise(conv)
        cols.append(conv.alias(name))
        bad = bad | conv.isNull()
    # Same barrier as in ``_extract``: the converted values become generator
    # outputs, so the mode's filter on ``_bad`` does not convert everything twice.
    row = F.struct(*cols, bad.alias("_bad"))
    return raw.select(*[F.col(c) for c in keep], F.inline(F.array(row)))


def _apply_mode(df: DataFrame, mode: str, what: str, value_col: str) -> DataFrame:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if mode == "strict":
        fail = F.raise_error(F.concat(F.lit(f"malformed {what} message: "), F.col(value_col)))
        df = df.where(F.when(F.col("_bad"), fail).isNull())
    else:
        df = df.where(~F.col("_bad"))
    return df.drop("_bad", value_col)


# Raw fields get positional names: the keys themselves collide case-insensitively.
_HEADER = [("_h0", "event_type", "string"), ("_h1", "event_time_ms", "bigint"), ("_h2", "symbol", "string")]
_HEADER_NAMES = ["_h0", "_h1", "_h2"]


def _kline_typed(messages: DataFrame, value_col: str) -> DataFrame:
    km = messages.where(is_kline(value_col))
    nested_names = [f"_k_{i}" for i in range(len(_K_FIELDS))]
    raw = _extract(km, value_col, ["e", "E", "s"], _HEADER_NAMES, [k for k, _, _ in _K_FIELDS], nested_names)
    typed = _HEADER + [(f"_k_{i}", name, dtype) for i, (_, name, dtype) in enumerate(_K_FIELDS)]
    return _typed(raw, typed, [value_col])


def parse_klines(messages: DataFrame, mode: str = "strict", value_col: str = "value") -> DataFrame:
    """Kline messages → one row per candle update with typed columns (``KLINE_COLUMNS``).

    Times stay in epoch milliseconds here: the windowed average needs them exact;
    the stored tables truncate to seconds.
    """
    return _apply_mode(_kline_typed(messages, value_col), mode, "kline", value_col)


def checked_klines(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """All kline messages, parsed once: for ``accepted`` and ``rejected`` of one persisted frame."""
    return _kline_typed(messages, value_col)


def accepted(checked: DataFrame, value_col: str = "value") -> DataFrame:
    return _apply_mode(checked, "permissive", "kline", value_col)


def rejected(checked: DataFrame, value_col: str = "value") -> DataFrame:
    return checked.where(F.col("_bad")).select(value_col)


def kline_rejects(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Kline-looking messages that do not parse or convert (permissive mode drops them)."""
    return rejected(checked_klines(messages, value_col), value_col)


def _trade_typed(messages: DataFrame, value_col: str, header_only: bool = False) -> DataFrame:
    tm = messages.where(is_trade(value_col))
    fields = [] if header_only else _TRADE_FIELDS
    keys = ["e", "E", "s"] + [k for k, _, _ in fields]
    names = _HEADER_NAMES + [f"_t_{i}" for i in range(len(fields))]
    raw = _extract(tm, value_col, keys, names)
    typed = _HEADER + [(f"_t_{i}", name, dtype) for i, (_, name, dtype) in enumerate(fields)]
    return _typed(raw, typed, [value_col])


def parse_trades(messages: DataFrame, mode: str = "strict", value_col: str = "value") -> DataFrame:
    """Trade messages → typed trades (``TRADE_COLUMNS``)."""
    return _apply_mode(_trade_typed(messages, value_col), mode, "trade", value_col)


def trade_rejects(messages: DataFrame, value_col: str = "value") -> DataFrame:
    return _trade_typed(messages, value_col).where(F.col("_bad")).select(value_col)


def trade_headers(messages: DataFrame, mode: str = "strict", value_col: str = "value") -> DataFrame:
    """What the reference keeps of a trade message: its header (e, E, s) only.

    Only the header keys are looked at: type and symbol must be present, an absent
    time is 0, and the trade body does not matter.
    """
    t = _apply_mode(_trade_typed(messages, value_col, header_only=True), mode, "trade", value_col)
    return t.select("event_type", millis_to_ts("event_time_ms").alias("event_time"), "symbol")


def typed_trades(messages: DataFrame, mode: str = "strict", value_col: str = "value") -> DataFrame:
    """Trades with timestamps instead of epoch milliseconds."""
    t = parse_trades(messages, mode, value_col)
    return t.select(
        "event_type", millis_to_ts("event_time_ms").alias("event_time"), "symbol", "trade_id", "price",
        "quantity", millis_to_ts("trade_time_ms").alias("trade_time"), "buyer_is_maker", "ignore_flag",
    )
