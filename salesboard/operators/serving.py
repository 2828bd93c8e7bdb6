"""Serving queries: total, ranking JSON, trend point, name lookup, snapshot.

Each serving result is one small row built from bounded inputs (a one-row
aggregate, a top-k, a point lookup), so nothing unbounded is ever gathered
into one task or to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from salesboard.functions.scalar import format_time, lagged_now
from salesboard.operators.ranking import RANKING_SIZE, top_shops
from salesboard.schema import DELTA_TYPE, M_SHOP, M_TOTAL, M_TREND

DEFAULT_LAG_SECONDS = 5


def serve_total(total_state: DataFrame, col: str = "total_amt") -> DataFrame:
    """One row ``total_amt`` (double); ``0`` before any batch."""
    return total_state.agg(F.coalesce(F.max(col), F.lit(0)).cast("double").alias("total_amt"))


def ranking_json(top: DataFrame, key: str = "shop_id", amt: str = "amt") -> DataFrame:
    """``[{"shop_name": <id>, "shop_amt_sum": <amt>}, ...]`` best first, from a bounded top-k.

    The served field ``shop_name`` holds the shop *id* (as upstream).
    """
    entry = F.struct((-F.col(amt)).alias("o1"), F.col(key).alias("o2"),
                     F.col(key).alias("shop_name"),
                     F.col(amt).cast(DELTA_TYPE).alias("shop_amt_sum"))
    ordered = F.sort_array(F.collect_list(entry))
    out = F.transform(ordered, lambda e: F.struct(e["shop_name"].alias("shop_name"),
                                                  e["shop_amt_sum"].alias("shop_amt_sum")))
    return top.agg(F.to_json(out).alias("ranking"))


def serve_ranking(shop_state: DataFrame, k: int = RANKING_SIZE, ties: str = "collapse",
                  key: str = "shop_id", amt: str = "amt") -> DataFrame:
    """Top-k ranking as one JSON text row (``[]`` when there is no shop)."""
    return ranking_json(top_shops(shop_state, k, ties, key, amt), key, amt)


def trend_point_json(x_time, amt) -> F.Column:
    return F.to_json(F.struct(format_time(x_time).alias("x_time"),
                              F.coalesce(amt.cast("double"), F.lit(0.0)).alias("time_amtSum")))


def serve_trend_point(trend_state: DataFrame, now, lag_seconds: int = DEFAULT_LAG_SECONDS,
                      bucket: str = "bucket", amt: str = "amt") -> DataFrame:
    """``{"x_time": ..., "time_amtSum": ...}`` for ``now - lag``, truncated to the second.

    ``now`` is a parameter (never the wall clock inside a query).  A missing
    point is ``0.0``.  ``bucket`` may be the stored text key: the lookup is then
    an equality on it, which the scan can take.
    """
    point = lagged_now(now, lag_seconds)
    hit = trend_state.where(_is_point(trend_state, bucket, point)).agg(F.sum(amt).alias("_a"))
    return hit.select(trend_point_json(point, F.col("_a")).alias("trend_point"))


def _is_point(trend_state: DataFrame, bucket: str, point) -> F.Column:
    text = isinstance(trend_state.schema[bucket].dataType, StringType)
    return F.col(bucket) == (format_time(point) if text else point)


def serve_trend_points(trend_state: DataFrame, clocks: DataFrame, lag_seconds: int = DEFAULT_LAG_SECONDS,
                       clock: str = "now", key: str = "key", amt: str = "amt") -> DataFrame:
    """All columns of ``clocks`` and ``x_time, time_amtSum``: the lagged point of every clock (``0.0`` where absent).

    One join on the stored text key, which has one row per second.
    """
    asked = clocks.withColumn("x_time", format_time(lagged_now(clock, lag_seconds)))
    points = trend_state.select(F.col(key).alias("x_time"), F.col(amt).cast("double").alias("_a"))
    return asked.join(points, "x_time", "left").select(
        *clocks.columns, "x_time", F.coalesce("_a", F.lit(0.0)).alias("time_amtSum"))


def latest_trend_point(trend_state: DataFrame, bucket: str = "bucket",
                       amt: str = "amt") -> DataFrame:
    """The newest point, i.e. the point served when ``now`` = newest bucket + lag."""
    last = trend_state.agg(F.max_by(F.struct(bucket, amt), bucket).alias("p"))
    return last.select(trend_point_json(F.col("p")[bucket], F.col("p")[amt]).alias("trend_point"))


def shop_dim_lookup(df: DataFrame, dim: DataFrame, key: str = "shop_id",
                    name: str = "shop_name", bounded: bool = False) -> DataFrame:
    """Shop id -> display name; a miss shows the id.

    ``bounded=True`` when ``df`` is a top-k: the dimension is first cut to
    the k ids with a semi join whose build side is the k ids (a proven size
    bound), so the big dimension is only streamed, never shuffled or
    broadcast.  Otherwise it is a plain left join and the optimizer (plus AQE
    at run time) picks broadcast or sort-merge by the actual sizes.
    """
    d = dim.select(key, F.col(name).alias("_name"))
    if bounded:
        d = (d.join(F.broadcast(df.select(key)), key, "left_semi")
             .groupBy(key).agg(F.min("_name").alias("_name")))
    out = df.join(d, key, "left")
    return out.select(*[c for c in df.columns if c != name],
                      F.coalesce(F.col("_name"), F.col(key)).alias(name))


def serving_snapshot(state: DataFrame, k: int = RANKING_SIZE,
                     lag_seconds: int = DEFAULT_LAG_SECONDS, now=None) -> DataFrame:
    """One row ``(total_amt, ranking, trend_point)`` from the ``(measure, key, amt)`` state.

    Built from three bounded pieces -- the total (1 row), the top-k shops and
    one trend point (1 row) -- unioned and folded by one aggregate.  The point is
    that of ``now - lag_seconds`` (0.0 where absent); without a clock, the newest
    one, which is what a clock ``lag_seconds`` past it would serve.
    """
    total = state.where(F.col("measure") == M_TOTAL).agg(F.sum("amt").alias("amt")) \
        .select(F.lit("t").alias("part"), F.lit(None).cast("string").alias("key"), "amt")
    shops = state.where(F.col("measure") == M_SHOP).select(F.col("key").alias("shop_id"), "amt")
    top = top_shops(shops, k).select(F.lit("s").alias("part"), F.col("shop_id").alias("key"), "amt")
    trend = state.where(F.col("measure") == M_TREND)
    if now is None:
        trend = trend.agg(F.max_by(F.struct("key", "amt"), "key").alias("p")) \
            .select(F.lit("p").alias("part"), F.col("p.key").alias("key"), F.col("p.amt").alias("amt"))
    else:
        point = lagged_now(now, lag_seconds)
        trend = trend.where(_is_point(trend, "key", point)).agg(F.sum("amt").alias("amt")) \
            .select(F.lit("p").alias("part"), format_time(point).alias("key"), "amt")
    parts = total.unionByName(top).unionByName(trend)
    entry = F.when(F.col("part") == "s", F.struct(
        (-F.col("amt")).alias("o1"), F.col("key").alias("o2"),
        F.col("key").alias("shop_name"), F.col("amt").cast(DELTA_TYPE).alias("shop_amt_sum")))
    ranked = F.transform(F.sort_array(F.collect_list(entry)), lambda e: F.struct(
        e["shop_name"].alias("shop_name"), e["shop_amt_sum"].alias("shop_amt_sum")))
    p_key = F.max(F.when(F.col("part") == "p", F.col("key")))
    p_amt = F.max(F.when(F.col("part") == "p", F.col("amt")))
    return parts.agg(
        F.coalesce(F.max(F.when(F.col("part") == "t", F.col("amt"))), F.lit(0))
        .cast("double").alias("total_amt"),
        F.to_json(ranked).alias("ranking"),
        F.when(p_key.isNull(), F.lit(None).cast("string"))
        .otherwise(trend_point_json(F.to_timestamp(p_key), p_amt)).alias("trend_point"),
    )
