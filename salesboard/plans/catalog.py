"""The query catalogue: one entry per operator, each with its SQL twin.

``QUERIES[name] = (fn(spark, sf_dir) -> DataFrame, oracle_sql | None)``.
Every query reads the given tables (or data Spark derives from them) in
full.  Result conventions: amounts are DOUBLE cast from exact decimal sums,
timestamps are zone-free, every computed column is aliased identically on
both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesboard.functions import scalar as fn
from salesboard.operators import measures as M
from salesboard.operators import parse as P
from salesboard.operators import ranking as R
from salesboard.plans.oracle import q
from salesboard.schema import RECORD_FIELDS
from salesboard.sources.logs import raw_log

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, oracle: str | None):
    def deco(f: QueryFn) -> QueryFn:
        QUERIES[name] = (f, oracle)
        return f
    return deco


# --- shared inputs ------------------------------------------------------------

TICK_CARRY = ("partition", "offset", "timestamp", "ordinal")


def ticks(spark: SparkSession, sf: str) -> DataFrame:
    """The ``raw_ticks`` envelope plus its ordinal (a log table built from ``events``)."""
    return raw_log(spark, sf, "ticks")


def ticks_parsed(spark: SparkSession, sf: str) -> DataFrame:
    return P.parse_records(ticks(spark, sf), carry=TICK_CARRY)


def ticks_valid(spark: SparkSession, sf: str) -> DataFrame:
    return P.valid_sales(ticks_parsed(spark, sf), carry=TICK_CARRY)


def sales_valid(spark: SparkSession, sf: str) -> DataFrame:
    return P.valid_sales(P.parse_records(raw_log(spark, sf, "sales"), carry=("ordinal",)),
                         carry=("ordinal",))


def dbl(c: str):
    return F.col(c).cast("double").alias(c)


def ntz(c: str):
    return F.col(c).cast("timestamp_ntz").alias(c)


# --- 2.2 parse ----------------------------------------------------------------

@query("split_record", q("""
SELECT "partition", "offset", n_fields FROM ticks_parsed"""))
def split_record(spark, sf):
    return ticks(spark, sf).select("partition", "offset",
                                   F.size(P.split_record("value")).alias("n_fields"))


@query("arity_filter", q("""
SELECT "partition", "offset", value FROM ticks_parsed WHERE n_fields = 13"""))
def arity_filter(spark, sf):
    t = ticks(spark, sf)
    return t.where(F.size(P.split_record("value")) == 13).select("partition", "offset", "value")


_FIELDS_SQL = ", ".join(f'"{f}"' if f in ("time", "rank") else f for f in
                        ("time", "url", "product_id", "name", "keyword", "rank", "current_price",
                         "original_price", "sales_count", "shipping_address", "shop_id",
                         "comments_count", "shop_name"))


@query("name_fields", q(f"""
SELECT "partition", "offset", {_FIELDS_SQL} FROM ticks_parsed WHERE n_fields = 13"""))
def name_fields(spark, sf):
    p = ticks_parsed(spark, sf).where(F.col("n_fields") == 13)
    return p.select("partition", "offset", *RECORD_FIELDS)


@query("price_low", q("""
SELECT "partition", "offset",
       trim(CASE WHEN contains(current_price, '-') THEN split_part(current_price, '-', 1)
                 ELSE current_price END) AS price_text
FROM ticks_parsed WHERE n_fields = 13"""))
def price_low(spark, sf):
    p = ticks_parsed(spark, sf).where(F.col("n_fields") == 13)
    return p.select("partition", "offset", fn.price_low("current_price").alias("price_text"))


@query("price_cast", q("""
SELECT "partition", "offset", CAST(price AS DOUBLE) AS price, price IS NOT NULL AS price_ok
FROM ticks_parsed WHERE n_fields = 13"""))
def price_cast(spark, sf):
    p = ticks_parsed(spark, sf).where(F.col("n_fields") == 13)
    return p.select("partition", "offset", dbl("price"), F.col("price").isNotNull().alias("price_ok"))


@query("slim_projection", q("""
SELECT "partition", "offset", "time", product_id, name, CAST(price AS DOUBLE) AS price,
       shop_id, shop_name
FROM ticks_valid"""))
def slim_projection(spark, sf):
    s = P.slim_projection(ticks_valid(spark, sf), carry=("partition", "offset"))
    return s.select("partition", "offset", ntz("time"), "product_id", "name", dbl("price"),
                    "shop_id", "shop_name")


@query("zero_fill_bad", q("""
SELECT "partition", "offset", CAST(CASE WHEN status IS NULL THEN price ELSE 0 END AS DOUBLE) AS amt
FROM ticks_parsed"""))
def zero_fill_bad(spark, sf):
    p = ticks_parsed(spark, sf)
    amt = F.when(F.col("status").isNull(), F.col("price")).otherwise(F.lit(0))
    return p.select("partition", "offset", amt.cast("double").alias("amt"))


@query("skip_blank_shop", q("""
SELECT CAST(SUM(price) AS DOUBLE) AS total_amt,
       CAST(SUM(price) FILTER (WHERE shop_id <> '') AS DOUBLE) AS ranked_amt,
       CAST(COALESCE(SUM(price) FILTER (WHERE shop_id = ''), 0) AS DOUBLE) AS blank_shop_amt,
       COUNT(*) FILTER (WHERE shop_id = '') AS n_blank_shop
FROM ticks_valid"""))
def skip_blank_shop(spark, sf):
    v = ticks_valid(spark, sf)
    blank = F.col("shop_id") == ""
    return v.agg(
        F.sum("price").cast("double").alias("total_amt"),
        F.sum(F.when(~blank, F.col("price"))).cast("double").alias("ranked_amt"),
        F.coalesce(F.sum(F.when(blank, F.col("price"))), F.lit(0)).cast("double")
        .alias("blank_shop_amt"),
        F.count(F.when(blank, 1)).alias("n_blank_shop"))


@query("drop_bad_trend", q("""
SELECT bucket, CAST(amt AS DOUBLE) AS amt FROM trend"""))
def drop_bad_trend(spark, sf):
    # bad rows become ("", 0) pairs upstream; dropping them before the sum
    p = ticks_parsed(spark, sf)
    t = F.when(F.col("status").isNull(), F.try_to_timestamp(F.col("time"), F.lit("yyyy-MM-dd HH:mm:ss")))
    pairs = p.select(F.date_trunc("second", t).alias("bucket"), "price").where(F.col("bucket").isNotNull())
    out = pairs.groupBy("bucket").agg(F.sum("price").alias("amt"))
    return out.select(ntz("bucket"), dbl("amt"))


# --- 2.4 aggregations (batch) ---------------------------------------------------

@query("batch_total", q("""
SELECT CAST(COALESCE(SUM(price), 0) AS DOUBLE) AS total_amt FROM ticks_valid"""))
def batch_total(spark, sf):
    return M.batch_total(ticks_valid(spark, sf)).select(dbl("total_amt"))


@query("batch_shop_amt", q("""
SELECT shop_id, CAST(amt AS DOUBLE) AS amt FROM shop_amt"""))
def batch_shop_amt(spark, sf):
    return M.batch_shop_amt(ticks_valid(spark, sf)).select("shop_id", dbl("amt"))


@query("batch_trend", q("""
SELECT bucket, CAST(amt AS DOUBLE) AS amt FROM trend"""))
def batch_trend(spark, sf):
    return M.batch_trend(ticks_valid(spark, sf)).select(ntz("bucket"), dbl("amt"))


# --- 2.5 ranking ----------------------------------------------------------------

_SHOP500 = """
shop500 AS (SELECT shop_id, CAST(FLOOR(amt / 500) * 500 AS DECIMAL(28,2)) AS amt FROM shop_amt)"""


def _shop500(spark, sf):
    s = M.batch_shop_amt(ticks_valid(spark, sf))
    return s.select("shop_id", (F.floor(F.col("amt") / 500) * 500).cast("decimal(28,2)").alias("amt"))


@query("top_shops", q("""
SELECT shop_id, CAST(amt AS DOUBLE) AS amt FROM (
  SELECT amt, MIN(shop_id) AS shop_id FROM shop500 GROUP BY amt
) ORDER BY amt DESC, shop_id LIMIT 5""", _SHOP500))
def top_shops(spark, sf):
    return R.top_shops(_shop500(spark, sf), ties="collapse").select("shop_id", dbl("amt"))


@query("top_shops_ties_all", q("""
SELECT shop_id, CAST(amt AS DOUBLE) AS amt FROM shop500 ORDER BY amt DESC, shop_id LIMIT 5""",
                                _SHOP500))
def top_shops_ties_all(spark, sf):
    return R.top_shops(_shop500(spark, sf), ties="all").select("shop_id", dbl("amt"))


_RANKED = """
SELECT CAST(row_number() OVER (ORDER BY amt DESC, shop_id) AS INTEGER) AS "rank", shop_id,
       CAST(amt AS DOUBLE) AS amt
FROM (SELECT amt, MIN(shop_id) AS shop_id FROM shop_amt GROUP BY amt ORDER BY amt DESC, shop_id LIMIT 5)"""


@query("rank_position", q(_RANKED))
def rank_position(spark, sf):
    top = R.top_shops(M.batch_shop_amt(ticks_valid(spark, sf)))
    return R.rank_position(top).select("rank", "shop_id", dbl("amt"))


@query("rank_tier", q(f"""
SELECT *, CASE "rank" WHEN 1 THEN 'gold' WHEN 2 THEN 'silver' WHEN 3 THEN 'bronze' END AS tier
FROM ({_RANKED.strip()})"""))
def rank_tier(spark, sf):
    top = R.top_shops(M.batch_shop_amt(ticks_valid(spark, sf)))
    return R.rank_tier(R.rank_position(top)).select("rank", "shop_id", dbl("amt"), "tier")


@query("rank_cap", q("""
SELECT shop_id, CAST(amt AS DOUBLE) AS amt FROM shop_amt ORDER BY amt DESC, shop_id LIMIT 6"""))
def rank_cap(spark, sf):
    return R.rank_cap(M.batch_shop_amt(ticks_valid(spark, sf))).select("shop_id", dbl("amt"))


@query("sort_by_measure", q("""
SELECT shop_id, CAST(amt AS DOUBLE) AS amt FROM shop_amt ORDER BY amt ASC, shop_id"""))
def sort_by_measure(spark, sf):
    s = M.batch_shop_amt(ticks_valid(spark, sf))
    return R.sort_by_measure(s, "amt", ascending=True, tie="shop_id").select("shop_id", dbl("amt"))
