"""Time helpers: epoch milliseconds, second truncation, month keys, range predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def millis_to_ts(ms: Column | str) -> Column:
    """Epoch milliseconds (BIGINT) → TIMESTAMP."""
    return F.timestamp_millis(_col(ms))


def ts_to_millis(ts: Column | str) -> Column:
    """TIMESTAMP / TIMESTAMP_NTZ → epoch milliseconds (UTC wall clock for NTZ)."""
    return F.unix_millis(_col(ts).cast("timestamp"))


def to_seconds(ts: Column | str) -> Column:
    """Drop sub-second digits, as the warehouse's second-resolution columns do."""
    return F.date_trunc("second", _col(ts))


def yyyymm(ts: Column | str) -> Column:
    """Month key of a timestamp as an INT such as 202407."""
    c = _col(ts)
    return (F.year(c) * 100 + F.month(c)).cast("int")


def _as_datetime(value) -> dt.datetime:
    """A bound as UTC wall clock; one with an offset is converted, so its month is the stored month."""
    if not isinstance(value, dt.datetime):
        value = (dt.datetime(value.year, value.month, value.day) if isinstance(value, dt.date)
                 else dt.datetime.fromisoformat(str(value)))
    return value.astimezone(dt.timezone.utc).replace(tzinfo=None) if value.tzinfo else value


def ts_literal(value) -> Column:
    """A TIMESTAMP literal read in the session time zone (UTC in this library)."""
    return F.lit(_as_datetime(value).isoformat(sep=" ")).cast("timestamp")


def month_key(value) -> int:
    d = _as_datetime(value)
    return d.year * 100 + d.month


def time_range(ts: Column | str, lo, hi, month_col: Column | str | None = "month") -> Column:
    """Half-open ``lo <= ts < hi`` plus the month-partition predicate that prunes.

    Parquet partition pruning only sees predicates on the partition column, so
    the raw time bounds are turned into ``month BETWEEN yyyymm(lo) AND
    yyyymm(hi - 1µs)`` as well; the exact time predicate stays for the edges.
    """
    lo_dt, hi_dt = _as_datetime(lo), _as_datetime(hi)
    c = _col(ts)
    cond = (c >= ts_literal(lo_dt)) & (c < ts_literal(hi_dt))
    if month_col is not None:
        m = _col(month_col)
        last = hi_dt - dt.timedelta(microseconds=1)
        cond = m.between(month_key(lo_dt), month_key(last)) & cond
    return cond
