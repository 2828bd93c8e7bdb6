"""Column helpers (all built-in Spark expressions, whole-stage codegen friendly)."""

from salesboard.functions.scalar import (  # noqa: F401
    clock_part,
    compact_time,
    format_time,
    hour_label,
    lagged_now,
    money,
    parse_time_ms,
    price_low,
    reverse_key,
    round0,
    to_second,
    zero_pad,
)
