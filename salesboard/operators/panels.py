"""Extensions: panels the wallboard draws from typed-in numbers upstream.

Upstream computes nothing for these; the record has the columns to answer
them, so they are offered as queries (labelled extensions).  All are
aggregate-then-rank: the ranking windows run over aggregated rows (one per
product / province / city / category-month), never over raw records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesboard.schema import DELTA_TYPE

# --- fixed values -----------------------------------------------------------
TOP_PRODUCTS = 6
TOP_PLACES = 8
VOLUME_STEP = "5 minutes"
# --- end of fixed values ----------------------------------------------------


def ext_top_products(valid: DataFrame, k: int = TOP_PRODUCTS) -> DataFrame:
    """Top products by sales amount: ``(product_id, name, amt)``.

    A hash aggregate per product and name first: the smallest name (text, so a sort
    aggregate) is taken from those rows, not from raw records.
    """
    named = valid.groupBy("product_id", "name").agg(F.sum("price").cast(DELTA_TYPE).alias("amt"))
    per = named.groupBy("product_id").agg(F.sum("amt").cast(DELTA_TYPE).alias("amt"),
                                          F.min("name").alias("name"))
    return per.orderBy(F.desc("amt"), F.asc("product_id")).limit(k).select("product_id", "name", "amt")


def ext_volume(valid: DataFrame, step: str = VOLUME_STEP) -> DataFrame:
    """Units sold per time bucket: ``(bucket, volume)``."""
    v = valid.where(F.col("time").isNotNull())
    return v.groupBy(F.window("time", step).start.alias("bucket")).agg(
        F.coalesce(F.sum("sales_count"), F.lit(0)).cast("long").alias("volume"))


def split_address(addr) -> tuple:
    """``'<province> <city>'`` -> (province, city); the city is everything after the first space."""
    a = F.col(addr) if isinstance(addr, str) else addr
    return (F.split_part(a, F.lit(" "), F.lit(1)),
            F.when(F.instr(a, " ") > 0, F.substr(a, F.instr(a, " ") + 1)))


def ext_region_rank(valid: DataFrame, k: int = TOP_PLACES) -> DataFrame:
    """Top provinces and top cities by amount: ``(level, name, amt, rank)``.

    The log is read once: amounts per province and city first, then each such row
    counts for its province and for its city.  ``rank <= k`` is applied in every
    task before the shuffle, so a level's window sees k rows a task.
    """
    prov, city = split_address("shipping_address")
    base = valid.select(prov.alias("province"), city.alias("city"), "price")
    per = base.groupBy("province", "city").agg(F.sum("price").cast(DELTA_TYPE).alias("amt"))
    levels = F.array(
        F.struct(F.lit("province").alias("level"), F.col("province").alias("name")),
        F.struct(F.lit("city").alias("level"),
                 F.when(F.col("city").isNotNull(), F.concat_ws(" ", "province", "city")).alias("name")))
    places = (per.select("amt", F.explode(levels).alias("p")).where("p.name is not null")
              .groupBy("p.level", "p.name").agg(F.sum("amt").cast(DELTA_TYPE).alias("amt")))
    w = Window.partitionBy("level").orderBy(F.desc("amt"), F.asc("name"))
    return (places.select("level", "name", "amt", F.row_number().over(w).alias("rank"))
            .where(F.col("rank") <= k))


def ext_category_growth(valid: DataFrame) -> DataFrame:
    """Per category and month: new sales, running total, growth = new / total before.

    ``(keyword, month, new_count, total_count, growth)``; growth is null for a
    category's first month.  The running total is a window over the monthly
    aggregate (months per category), not over records.
    """
    monthly = (valid.where(F.col("time").isNotNull())
               .groupBy("keyword", F.date_trunc("month", "time").alias("month"))
               .agg(F.count(F.lit(1)).alias("new_count")))
    w = Window.partitionBy("keyword").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    run = monthly.withColumn("total_count", F.sum("new_count").over(w))
    before = F.col("total_count") - F.col("new_count")
    return run.select("keyword", "month", "new_count", "total_count",
                      F.when(before > 0, F.col("new_count") / before).alias("growth"))
