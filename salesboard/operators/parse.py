"""Split, validate and type raw ``^``-delimited sale records.

All steps are narrow (no shuffle) and fuse into one whole-stage-codegen
stage right after the scan.  Bad rows are not dropped silently: they go to a
quarantine frame with a reason, so ``valid`` + ``quarantine`` = input.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesboard.functions.scalar import price_low
from salesboard.schema import (
    BAD_ARITY,
    BAD_PRICE,
    FIELD_SEPARATOR,
    N_FIELDS,
    PRICE_TYPE,
    RECORD_FIELDS,
    TIME_FORMAT,
    VALID_SALE_COLUMNS,
)

_SEPARATOR_RE = r"\^"


def _body(value) -> Column:
    """The record without trailing separators (so trailing empty fields drop)."""
    v = value if isinstance(value, Column) else F.col(value)
    return F.rtrim(v, F.lit(FIELD_SEPARATOR))


def split_record(value) -> Column:
    """Split on a literal ``^``; trailing empty fields are dropped.

    ``'a^b^^'`` -> ``['a', 'b']``; plain ``split`` would keep the two empties.
    A line of separators only has no field at all; an empty line has one.
    """
    v = value if isinstance(value, Column) else F.col(value)
    body = _body(v)
    return F.when((body == "") & (v != ""), F.array().cast("array<string>")) \
        .otherwise(F.split(body, _SEPARATOR_RE))


def field_count(body: Column, value: Column | None = None) -> Column:
    """Number of fields of a trimmed body, without splitting it.

    As in a split that drops trailing empty fields: an empty line has one
    (empty) field, a line of separators only has none.
    """
    n = F.length(body) - F.length(F.replace(body, F.lit(FIELD_SEPARATOR), F.lit(""))) + 1
    if value is None:
        return n
    return F.when((body == "") & (value != ""), F.lit(0)).otherwise(n)


def field_at(body: Column, i: int) -> Column:
    """Field ``i`` (0-based) of a body, without splitting it (valid when i < count)."""
    return F.substring_index(F.substring_index(body, FIELD_SEPARATOR, i + 1), FIELD_SEPARATOR, -1)


def name_fields(fields: Column) -> list[Column]:
    """Position -> named string column.  ``get`` is null out of range (ANSI-safe)."""
    return [F.get(fields, i).alias(name) for i, name in enumerate(RECORD_FIELDS)]


def price_cast(text) -> Column:
    """Price text -> decimal(18,2); null when it is not a finite number."""
    t = text if isinstance(text, Column) else F.col(text)
    return t.try_cast(PRICE_TYPE)


def _status(n_fields: Column, price: Column) -> Column:
    return (F.when(n_fields != N_FIELDS, F.lit(BAD_ARITY))
            .when(price.isNull(), F.lit(BAD_PRICE)))


def parse_records(raw: DataFrame, value_col: str = "value",
                  carry: Sequence[str] = ()) -> DataFrame:
    """One row per input record with all 13 named fields, typed price and status.

    ``status`` is null for a valid row, else ``bad_arity`` / ``bad_price``.
    ``carry`` columns of ``raw`` (offsets, ingest time, ...) are kept.

    Plan shape: the status inputs (field count, price field) are scalar
    string scans of the trimmed body, so when the optimizer pushes a
    ``status`` filter below this projection it copies only cheap
    expressions; the full split runs once per row, above the filter.
    """
    stage, typed, final = _parse_columns(value_col, tuple(carry))
    return raw.select(*stage).select(*typed).select(*final)


@lru_cache(maxsize=64)
def _parse_columns(value_col: str, carry: tuple) -> tuple:
    """The three projections of ``parse_records``.

    Built once per process and reused: they are unresolved expressions, and
    building them costs one JVM round trip per node -- too much to repeat in
    every micro-batch.
    """
    keep = [F.col(c) for c in carry]
    stage = [*keep, F.col(value_col).alias("value"), _body(F.col(value_col)).alias("_b")]
    b = F.col("_b")
    n = field_count(b, F.col("value"))
    price = price_cast(price_low(field_at(b, RECORD_FIELDS.index("current_price"))))
    typed = [*keep, F.col("value"), n.alias("n_fields"),
             F.split(b, _SEPARATOR_RE).alias("_f"), price.alias("price")]
    final = [*keep, F.col("value"), F.col("n_fields"), *name_fields(F.col("_f")), F.col("price"),
             _status(F.col("n_fields"), F.col("price")).alias("status")]
    return tuple(stage), tuple(typed), tuple(final)


def valid_sales(parsed: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Typed valid sales: the six measure columns plus carried extras."""
    return parsed.where(F.col("status").isNull()).select(
        *[F.col(c) for c in carry],
        F.try_to_timestamp(F.col("time"), F.lit(TIME_FORMAT)).alias("time"),
        "product_id",
        "name",
        "price",
        "shop_id",
        "shop_name",
        "keyword",
        F.col("sales_count").try_cast("int").alias("sales_count"),
        "shipping_address",
    )


def quarantine(parsed: DataFrame) -> DataFrame:
    """Rejected rows: the raw line, its field count and the reason."""
    return parsed.where(F.col("status").isNotNull()).select(
        "value", "n_fields", F.col("status").alias("reason"))


def parse_sales(raw: DataFrame, value_col: str = "value",
                carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantine)`` from a frame with a text column of records.

    Works on a streaming frame too.  Both outputs come from the same plan; in a
    micro-batch, persist ``raw`` first so the source is read once.
    """
    parsed = parse_records(raw, value_col, carry)
    return valid_sales(parsed, carry), quarantine(parsed)


def slim_projection(valid: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The six columns the measures need (plus carried keys)."""
    return valid.select(*carry, *VALID_SALE_COLUMNS)
