"""Scalar Column functions.

Each helper returns a ``Column`` built only from ``pyspark.sql.functions``,
so it stays inside whole-stage codegen and works on batch and stream alike.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesboard.schema import COMPACT_TIME_FORMAT, TIME_FORMAT

# --- fixed values -----------------------------------------------------------
MONEY_INVALID = "invalid value"      # shown for a negative amount
CLOCK_FORMAT = "HH:mm:ss"
DEFAULT_LAG_SECONDS = 5              # the served trend point lags "now" by 5 s
# --- end of fixed values ----------------------------------------------------


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def _ts(x) -> Column:
    """A Column, a column name, or a ``datetime`` / ``'yyyy-MM-dd HH:mm:ss'`` literal."""
    if isinstance(x, Column):
        return x
    if isinstance(x, _dt.datetime):
        return F.lit(x).cast("timestamp")
    if isinstance(x, str) and len(x) >= 10 and x[4:5] == "-" and x[:4].isdigit():
        return F.to_timestamp(F.lit(x))
    return F.col(x)


def format_time(ts) -> Column:
    """timestamp -> ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.date_format(_ts(ts), TIME_FORMAT)


def parse_time_ms(text) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> epoch milliseconds, ``-1`` when unparsable.

    Strict: an impossible date (month 13) is -1 rather than rolled over.
    """
    parsed = F.try_to_timestamp(_c(text), F.lit(TIME_FORMAT))
    return F.coalesce(F.unix_millis(parsed), F.lit(-1).cast("long"))


def to_second(ts) -> Column:
    """Truncate to the whole second (the bucket and the lookup key agree)."""
    return F.date_trunc("second", _ts(ts))


def reverse_key(ts) -> Column:
    """Reversed epoch-millisecond text of the second: the store's row key."""
    return F.reverse(F.unix_millis(to_second(ts)).cast("string"))


def lagged_now(now, seconds: int = DEFAULT_LAG_SECONDS) -> Column:
    """``now - seconds``, truncated to the second so it can hit a bucket."""
    return to_second(_ts(now) - F.make_dt_interval(secs=F.lit(seconds)))


def compact_time(ts, minus_ms: int | Column = 0) -> Column:
    """``ts - minus_ms`` as ``yyyyMMdd-HH:mm:ss``."""
    ms = minus_ms if isinstance(minus_ms, Column) else F.lit(int(minus_ms))
    secs = (ms.cast("decimal(20,3)") / F.lit(1000)).cast("decimal(18,6)")
    return F.date_format(_ts(ts) - F.make_dt_interval(secs=secs), COMPACT_TIME_FORMAT)


def clock_part(ts) -> Column:
    """Time-of-day label of a timestamp."""
    return F.date_format(_ts(ts), CLOCK_FORMAT)


def money(x) -> Column:
    """Two decimals with thousands separators; a negative amount is invalid."""
    x = _c(x)
    return F.when(x < 0, F.lit(MONEY_INVALID)).otherwise(F.format_number(x, 2))


def zero_pad(x, n: int = 2) -> Column:
    """Left-pad with ``0`` keeping the *last* ``n`` characters (``123`` -> ``23``)."""
    s = _c(x).cast("string")
    return F.right(F.concat(F.lit("0" * (n - 1)), s), F.lit(n))


def hour_label(hour_text, idx) -> Column:
    """Hour axis label: ``00`` after the first slot is the day's end, ``24``."""
    h = _c(hour_text)
    return F.when((h == "00") & (_c(idx) > 1), F.lit("24")).otherwise(h)


def round0(x) -> Column:
    """Whole-number label (half away from zero on the exact decimal)."""
    return F.round(_c(x), 0)


def price_low(text) -> Column:
    """A price may be a range ``low - high``: keep the text before the first ``-``."""
    return F.trim(F.substring_index(_c(text), "-", 1))
