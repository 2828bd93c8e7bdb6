"""The three measures: total amount, amount per shop, amount per time bucket.

Every measure is a hash aggregate with a partial (map-side) step, so a hot
shop or a busy second costs one pre-aggregated row per map task in the
shuffle, whatever its share of the rows.  Amounts stay exact decimals;
``as_double`` casts at the edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesboard.schema import DELTA_TYPE

#: Where the trend takes its time from (see ``bucket_time``).
TIME_SOURCES = ("event", "ingest", "processing")


def _zero() -> Column:
    return F.lit(0).cast(DELTA_TYPE)


def batch_total(valid: DataFrame, price: str = "price") -> DataFrame:
    """One row ``total_amt``; ``0`` for an empty (or all-bad) batch."""
    return valid.agg(F.coalesce(F.sum(price).cast(DELTA_TYPE), _zero()).alias("total_amt"))


def batch_shop_amt(valid: DataFrame, price: str = "price", shop: str = "shop_id") -> DataFrame:
    """``(shop_id, amt)``.  A blank shop id is not a shop: it counts in the
    total and the trend, never in the ranking."""
    return (valid.where(F.col(shop) != "")
            .groupBy(shop).agg(F.sum(price).cast(DELTA_TYPE).alias("amt")))


def bucket_time(time_col: str = "event", event="time", ingest="timestamp") -> Column:
    """The time a row is bucketed by.

    ``event``      the record's own time field (default; deterministic)
    ``ingest``     the source's arrival timestamp (topic ``timestamp``)
    ``processing`` the micro-batch clock (one value per batch)
    """
    if time_col == "event":
        return event if isinstance(event, Column) else F.col(event)
    if time_col == "ingest":
        return ingest if isinstance(ingest, Column) else F.col(ingest)
    if time_col == "processing":
        return F.current_timestamp()
    raise ValueError(f"time_col must be one of {TIME_SOURCES}, got {time_col!r}")


def bucket_start(ts: Column, step: str = "1 second") -> Column:
    """Start of the tumbling bucket of ``step`` holding ``ts``."""
    if step == "1 second":
        return F.date_trunc("second", ts)
    return F.window(ts, step).start


def batch_trend(valid: DataFrame, time_col: str = "event", step: str = "1 second",
                price: str = "price") -> DataFrame:
    """``(bucket, amt)`` per time bucket.  Rows whose time is missing are left out."""
    t = bucket_time(time_col)
    return (valid.select(t.alias("_t"), price).where(F.col("_t").isNotNull())
            .groupBy(bucket_start(F.col("_t"), step).alias("bucket"))
            .agg(F.sum(price).cast(DELTA_TYPE).alias("amt")))


def as_double(df: DataFrame, *cols: str) -> DataFrame:
    """Cast exact amounts to double at the serving edge."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def ntz(df: DataFrame, *cols: str) -> DataFrame:
    """Zone-free timestamps for output (wall-clock values in UTC)."""
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in cols else F.col(c)
                       for c in df.columns])
