"""Time-series operators over a ``(bucket, amt)`` trend.

``dense_axis``   every step of each day that has data, value null until it arrives
``series_peak``  the maximum point per day (ties -> earliest)
``series_last_n`` the newest n points, returned oldest first
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesboard.functions.scalar import hour_label, zero_pad

# --- fixed values -----------------------------------------------------------
DAY_SECONDS = 24 * 60 * 60
AXIS_EXTRA_SECONDS = 100     # the axis runs 100 s past the day's end
LAST_N = 10                  # points kept by the rolling series
# --- end of fixed values ----------------------------------------------------


def day_grid(days: DataFrame, step_seconds: int, extra_seconds: int = AXIS_EXTRA_SECONDS,
             day: str = "day") -> DataFrame:
    """``(day, idx, bucket)``: ``day + i*step`` for ``i*step <= 1 day + extra``.

    Each day row expands to a fixed number of points (set by the step, not by
    the data), so the expansion is spread over the tasks holding the days.
    """
    stop = F.col(day) + F.make_dt_interval(secs=F.lit(DAY_SECONDS + extra_seconds))
    seq = F.sequence(F.col(day), stop, F.make_dt_interval(secs=F.lit(step_seconds)))
    return days.select(day, F.posexplode(seq).alias("idx", "bucket"))


def dense_axis(trend: DataFrame, step_seconds: int = 300, extra_seconds: int = AXIS_EXTRA_SECONDS,
               bucket: str = "bucket", amt: str = "amt", fill=None) -> DataFrame:
    """Dense axis per day with data: ``(day, idx, bucket, amt)``, missing = ``fill`` (null).

    No grid is joined: each point emits itself and the run of missing steps up to
    the next point of its day (``lead``), the first point also the run before it.
    The steps past the day's end show the next day's first points, which are
    therefore handed to the day before as well.  A window sees one row per step
    of a day, a number that the step fixes.
    """
    step, last = int(step_seconds), (DAY_SECONDS + int(extra_seconds)) // int(step_seconds)
    day = F.date_trunc("day", F.col(bucket))
    second = (F.unix_seconds(F.col(bucket)) - F.unix_seconds(day)).cast("long")
    own = trend.select(day.alias("day"), F.floor(second / step).alias("idx"), F.col(amt).alias("amt"))
    tail = trend.where(F.floor((second + DAY_SECONDS) / step) <= last).select(
        (day - F.make_dt_interval(days=F.lit(1))).alias("day"), F.floor((second + DAY_SECONDS) / step).alias("idx"), F.col(amt).alias("amt"))
    days = own.select("day").distinct()                      # the tail alone makes no day
    points = (own.unionByName(tail.join(days, "day", "left_semi"))
              .groupBy("day", "idx").agg(F.sum("amt").alias("amt")))
    w = Window.partitionBy("day").orderBy("idx")
    run = points.withColumn("_from", F.when(F.lag("idx").over(w).isNull(), F.lit(0).cast("long")).otherwise(F.col("idx"))) \
        .withColumn("_to", F.coalesce(F.lead("idx").over(w) - 1, F.lit(last).cast("long")))
    value = F.when(F.col("_i") == F.col("idx"), F.col("amt"))
    return run.select("*", F.explode(F.sequence("_from", "_to")).alias("_i")).select(
        "day", F.col("_i").cast("int").alias("idx"), (F.col("day") + F.make_dt_interval(secs=F.col("_i") * step)).alias("bucket"),
        (value if fill is None else F.coalesce(value, F.lit(fill))).alias("amt"))


def hour_axis(days: DataFrame, day: str = "day") -> DataFrame:
    """Hour labels of each day's axis: ``00``..``23`` then ``24`` for the closing tick."""
    g = day_grid(days, 3600, 0, day)
    return g.select(day, "idx", hour_label(zero_pad(F.hour("bucket"), 2), F.col("idx")).alias("label"))


def series_peak(trend: DataFrame, bucket: str = "bucket", amt: str = "amt") -> DataFrame:
    """Per day: the peak amount and its bucket; equal peaks -> the earliest.

    The peak of each day first, then the buckets that have it: two hash aggregates.
    """
    daily = trend.select(F.date_trunc("day", bucket).alias("day"), F.col(bucket).alias("_b"), F.col(amt).alias("peak_amt"))
    peaks = daily.groupBy("day").agg(F.max("peak_amt").alias("peak_amt"))
    return (daily.join(peaks, ["day", "peak_amt"], "left_semi").groupBy("day", "peak_amt")
            .agg(F.min("_b").alias("peak_bucket")).select("day", "peak_bucket", "peak_amt"))


def series_last_n(trend: DataFrame, n: int = LAST_N, bucket: str = "bucket") -> DataFrame:
    """Newest ``n`` points (a bounded top-n), then re-sorted oldest first."""
    return trend.orderBy(F.desc(bucket)).limit(n).orderBy(bucket)
