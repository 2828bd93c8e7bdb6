"""Catalogue entries for scalar functions, series, tree, lookups and panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesboard.functions import scalar as fn
from salesboard.operators import measures as M
from salesboard.operators import panels as X
from salesboard.operators import ranking as R
from salesboard.operators import series as SE
from salesboard.operators import serving as S
from salesboard.operators import tree as TR
from salesboard.plans.catalog import dbl, ntz, query, sales_valid, ticks, ticks_valid
from salesboard.plans.oracle import q
from salesboard.session import fresh_dir
from salesboard.sources import fixtures as FX
from salesboard.streaming.feeder import log_slice as _log_slice
from salesboard.streaming.feeder import with_line_ordinal


def _trend(spark, sf):
    return M.batch_trend(ticks_valid(spark, sf))


def _events(spark, sf):
    return FX.table(spark, sf, "events")


# --- 2.7 scalar functions -----------------------------------------------------------

@query("fn_format_time", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_text FROM events""")
def fn_format_time(spark, sf):
    return _events(spark, sf).select("event_id", fn.format_time("ts").alias("time_text"))


@query("fn_parse_time", q("""
SELECT "partition", "offset",
       COALESCE(epoch_ms(try_strptime(string_split(value, '^')[1], '%Y-%m-%d %H:%M:%S')), -1) AS epoch_ms
FROM raw_ticks"""))
def fn_parse_time(spark, sf):
    t = ticks(spark, sf)
    first = F.split_part("value", F.lit("^"), F.lit(1))
    return t.select("partition", "offset", fn.parse_time_ms(first).alias("epoch_ms"))


@query("fn_reverse_key", q("""
SELECT bucket, reverse(CAST(epoch_ms(bucket) AS VARCHAR)) AS row_key FROM trend"""))
def fn_reverse_key(spark, sf):
    t = _trend(spark, sf)
    return t.select(ntz("bucket"), fn.reverse_key("bucket").alias("row_key"))


@query("fn_lagged_now", """
SELECT event_id, date_trunc('second', ts - INTERVAL 5 SECOND) AS lagged FROM events""")
def fn_lagged_now(spark, sf):
    e = _events(spark, sf).select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return e.select("event_id", fn.lagged_now("ts").cast("timestamp_ntz").alias("lagged"))


@query("fn_compact_time", """
SELECT event_id, strftime(ts, '%Y%m%d-%H:%M:%S') AS now_text,
       strftime(ts - INTERVAL 1500 MILLISECOND, '%Y%m%d-%H:%M:%S') AS earlier_text
FROM events""")
def fn_compact_time(spark, sf):
    e = _events(spark, sf).select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return e.select("event_id", fn.compact_time("ts").alias("now_text"),
                    fn.compact_time("ts", 1500).alias("earlier_text"))


@query("fn_text_ops", q("""
SELECT "partition", "offset", contains(value, ' - ') AS has_range,
       CAST(len(string_split(value, '^')) AS INTEGER) AS n_parts,
       CAST(length(trim(value)) AS INTEGER) AS n_chars
FROM raw_ticks"""))
def fn_text_ops(spark, sf):
    t = ticks(spark, sf)
    return t.select("partition", "offset", F.col("value").contains(" - ").alias("has_range"),
                    F.size(F.split("value", r"\^")).alias("n_parts"),
                    F.length(F.trim("value")).alias("n_chars"))


@query("fn_money", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'invalid value' ELSE format('{:,.2f}', c_acctbal) END AS money
FROM customer""")
def fn_money(spark, sf):
    c = FX.table(spark, sf, "customer")
    return c.select("c_custkey", fn.money("c_acctbal").alias("money"))


@query("fn_clock_part", q("""
SELECT bucket, strftime(bucket, '%H:%M:%S') AS clock FROM trend"""))
def fn_clock_part(spark, sf):
    t = _trend(spark, sf)
    return t.select(ntz("bucket"), fn.clock_part("bucket").alias("clock"))


@query("fn_zero_pad", """
SELECT event_id, right('0' || CAST(event_id AS VARCHAR), 2) AS id2,
       right('0' || CAST(hour(ts) AS VARCHAR), 2) AS hour2,
       right('00' || CAST(event_id % 97 AS VARCHAR), 3) AS product3
FROM events""")
def fn_zero_pad(spark, sf):
    e = _events(spark, sf)
    return e.select("event_id", fn.zero_pad("event_id", 2).alias("id2"),
                    fn.zero_pad(F.hour("ts"), 2).alias("hour2"),
                    fn.zero_pad(F.col("event_id") % 97, 3).alias("product3"))


_DAYS = """
days AS (SELECT DISTINCT date_trunc('day', bucket) AS day FROM trend)"""


@query("fn_hour_label", q("""
SELECT day, idx, CASE WHEN h = '00' AND idx > 1 THEN '24' ELSE h END AS label
FROM (
  SELECT day, CAST(g.i AS INTEGER) AS idx,
         right('0' || CAST(hour(day + g.i * INTERVAL 1 HOUR) AS VARCHAR), 2) AS h
  FROM days, (SELECT unnest(range(0, 25)) AS i) g
)""", _DAYS))
def fn_hour_label(spark, sf):
    days = _trend(spark, sf).select(F.date_trunc("day", "bucket").alias("day")).distinct()
    return SE.hour_axis(days).select(ntz("day"), "idx", "label")


@query("fn_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def fn_json(spark, sf):
    e = _events(spark, sf)
    return e.select("event_id", F.from_json("props", "k INT")["k"].alias("k"))


@query("fn_round0", q("""
SELECT shop_id, CAST(round(amt, 0) AS DOUBLE) AS amt0 FROM shop_amt"""))
def fn_round0(spark, sf):
    s = M.batch_shop_amt(ticks_valid(spark, sf))
    return s.select("shop_id", fn.round0("amt").cast("double").alias("amt0"))


# --- 2.1 log slice, 2.3 lookup ---------------------------------------------------------

@query("log_slice", q("""
SELECT ordinal, value FROM raw_ticks WHERE ordinal >= 1000 AND ordinal < 3500"""))
def log_slice(spark, sf):
    return _log_slice(ticks(spark, sf), 1000, 2500).select("ordinal", "value")


@query("log_slice_text", q("""
SELECT n AS ordinal, value
FROM (SELECT CAST(row_number() OVER (ORDER BY ordinal) - 1 AS BIGINT) AS n, value FROM raw_ticks)
WHERE n >= 1000 AND n < 3500"""))
def log_slice_text(spark, sf):
    # the log as text files whose names follow the order of their lines
    path = fresh_dir(spark, "text-log")
    ticks(spark, sf).orderBy("ordinal").select("value").write.text(path)
    return _log_slice(with_line_ordinal(spark.read.text(path)), 1000, 2500).select("ordinal", "value")


@query("shop_dim_lookup", q("""
SELECT r."rank", r.shop_id, COALESCE(d.shop_name, r.shop_id) AS shop_name, r.amt
FROM (""" + """
SELECT CAST(row_number() OVER (ORDER BY amt DESC, shop_id) AS INTEGER) AS "rank", shop_id,
       CAST(amt AS DOUBLE) AS amt
FROM (SELECT amt, MIN(shop_id) AS shop_id FROM shop_amt GROUP BY amt ORDER BY amt DESC, shop_id LIMIT 5)
""" + """) r LEFT JOIN (
  SELECT CAST(s_suppkey AS VARCHAR) AS shop_id, MIN(s_name) AS shop_name FROM supplier GROUP BY 1
) d ON r.shop_id = d.shop_id"""))
def shop_dim_lookup(spark, sf):
    # the shop dimension: supplier key -> name; shop ids beyond the suppliers miss
    dim = FX.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("shop_id"), F.col("s_name").alias("shop_name"))
    top = R.rank_position(R.top_shops(M.batch_shop_amt(ticks_valid(spark, sf))))
    out = S.shop_dim_lookup(top, dim, bounded=True)
    return out.select("rank", "shop_id", "shop_name", dbl("amt"))


# --- 2.8 series -----------------------------------------------------------------------------

@query("dense_axis", q("""
SELECT d.day, CAST(g.i AS INTEGER) AS idx, d.day + g.i * INTERVAL 300 SECOND AS bucket,
       CAST(t.amt AS DOUBLE) AS amt
FROM days d CROSS JOIN (SELECT unnest(range(0, 289)) AS i) g
LEFT JOIN (SELECT time_bucket(INTERVAL 300 SECOND, bucket) AS b, SUM(amt) AS amt FROM trend GROUP BY 1) t
  ON t.b = d.day + g.i * INTERVAL 300 SECOND""", _DAYS))
def dense_axis(spark, sf):
    a = SE.dense_axis(_trend(spark, sf), step_seconds=300)
    return a.select(ntz("day"), "idx", ntz("bucket"), dbl("amt"))


@query("dense_axis_1s", q("""
SELECT d.day, CAST(g.i AS INTEGER) AS idx, d.day + g.i * INTERVAL 1 SECOND AS bucket,
       CAST(t.amt AS DOUBLE) AS amt
FROM days d CROSS JOIN (SELECT unnest(range(0, 86501)) AS i) g
LEFT JOIN trend t ON t.bucket = d.day + g.i * INTERVAL 1 SECOND""", _DAYS))
def dense_axis_1s(spark, sf):
    # the wallboard's own axis: every second of the day and 100 seconds past it
    a = SE.dense_axis(_trend(spark, sf), step_seconds=1)
    return a.select(ntz("day"), "idx", ntz("bucket"), dbl("amt"))


@query("series_peak", q("""
SELECT day, bucket AS peak_bucket, CAST(amt AS DOUBLE) AS peak_amt FROM (
  SELECT date_trunc('day', bucket) AS day, bucket, amt,
         row_number() OVER (PARTITION BY date_trunc('day', bucket) ORDER BY amt DESC, bucket) AS rn
  FROM trend) WHERE rn = 1"""))
def series_peak(spark, sf):
    p = SE.series_peak(_trend(spark, sf))
    return p.select(ntz("day"), ntz("peak_bucket"), dbl("peak_amt"))


@query("series_last_n", q("""
SELECT bucket, CAST(amt AS DOUBLE) AS amt FROM trend ORDER BY bucket DESC LIMIT 10"""))
def series_last_n(spark, sf):
    return SE.series_last_n(_trend(spark, sf)).select(ntz("bucket"), dbl("amt"))


# --- 2.8 tree -------------------------------------------------------------------------------

_TREE_NODES = """
nodes AS (
  SELECT 'all' AS node, CAST(NULL AS VARCHAR) AS parent, CAST(0 AS BIGINT) AS size
  UNION ALL SELECT 'R:' || r_name, 'all', CAST(r_regionkey + 1 AS BIGINT) FROM region
  UNION ALL SELECT 'N:' || n_name, 'R:' || r_name, CAST(n_nationkey % 3 + 1 AS BIGINT)
            FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'S:' || CAST(s_suppkey AS VARCHAR), 'N:' || n_name, CAST(1 AS BIGINT)
            FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""

_CLOSURE = """
closure(node, anc, dist) AS (
  SELECT node, node, 0 FROM nodes
  UNION ALL
  SELECT c.node, n.parent, c.dist + 1 FROM closure c JOIN nodes n ON c.anc = n.node
  WHERE n.parent IS NOT NULL
),
rollup AS (
  SELECT c.anc AS node, CAST(SUM(n.size) AS BIGINT) AS value FROM closure c JOIN nodes n ON c.node = n.node GROUP BY c.anc
)"""


def tree_nodes(spark, sf):
    """Region -> nation -> supplier tree; interior nodes carry an own size too."""
    r = FX.table(spark, sf, "region")
    n = FX.table(spark, sf, "nation")
    s = FX.table(spark, sf, "supplier")
    rn = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)   # both fixed-size
    root = spark.range(1).select(F.lit("all").alias("node"), F.lit(None).cast("string").alias("parent"),
                                 F.lit(0).cast("long").alias("size"))
    regions = r.select(F.concat(F.lit("R:"), "r_name").alias("node"), F.lit("all").alias("parent"),
                       (F.col("r_regionkey") + 1).cast("long").alias("size"))
    nations = rn.select(F.concat(F.lit("N:"), "n_name").alias("node"),
                        F.concat(F.lit("R:"), "r_name").alias("parent"),
                        (F.col("n_nationkey") % 3 + 1).cast("long").alias("size"))
    sups = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).select(
        F.concat(F.lit("S:"), F.col("s_suppkey").cast("string")).alias("node"),
        F.concat(F.lit("N:"), "n_name").alias("parent"), F.lit(1).cast("long").alias("size"))
    return root.unionByName(regions).unionByName(nations).unionByName(sups)


@query("tree_rollup", "WITH RECURSIVE " + _TREE_NODES.strip() + ",\n" + _CLOSURE.strip() + """
SELECT node, value FROM rollup""")
def tree_rollup(spark, sf):
    return TR.tree_rollup(tree_nodes(spark, sf))


@query("tree_sort", "WITH RECURSIVE " + _TREE_NODES.strip() + ",\n" + _CLOSURE.strip() + """
SELECT r.node, n.parent, r.value,
       row_number() OVER (PARTITION BY n.parent ORDER BY r.value DESC, r.node) AS sibling_rank
FROM rollup r JOIN nodes n ON r.node = n.node""")
def tree_sort(spark, sf):
    return TR.tree_sort(tree_nodes(spark, sf))


@query("tree_flatten", "WITH RECURSIVE " + _TREE_NODES.strip() + ",\n" + _CLOSURE.strip() + """,
depth AS (SELECT node, MAX(dist) AS depth FROM closure GROUP BY node)
SELECT n.node, n.parent, CAST(d.depth AS INTEGER) AS depth,
       NOT EXISTS (SELECT 1 FROM nodes c WHERE c.parent = n.node) AS is_leaf,
       CAST((SELECT MAX(depth) FROM depth) AS INTEGER) AS max_depth
FROM nodes n JOIN depth d ON n.node = d.node WHERE n.parent IS NOT NULL""")
def tree_flatten(spark, sf):
    return TR.tree_flatten(tree_nodes(spark, sf))


# --- 2.8.1 extensions -------------------------------------------------------------------------

@query("ext_top_products", q("""
SELECT product_id, MIN(name) AS name, CAST(SUM(price) AS DOUBLE) AS amt FROM sales_valid
GROUP BY product_id ORDER BY SUM(price) DESC, product_id LIMIT 6"""))
def ext_top_products(spark, sf):
    return X.ext_top_products(sales_valid(spark, sf)).select("product_id", "name", dbl("amt"))


@query("ext_volume_5min", q("""
SELECT time_bucket(INTERVAL 5 MINUTE, "time") AS bucket, CAST(COALESCE(SUM(sales_count), 0) AS BIGINT) AS volume
FROM ticks_valid WHERE "time" IS NOT NULL GROUP BY 1"""))
def ext_volume_5min(spark, sf):
    return X.ext_volume(ticks_valid(spark, sf)).select(ntz("bucket"), "volume")


@query("ext_region_rank", q("""
SELECT 'province' AS level, name, CAST(amt AS DOUBLE) AS amt,
       CAST(row_number() OVER (ORDER BY amt DESC, name) AS INTEGER) AS "rank"
FROM (SELECT split_part(shipping_address, ' ', 1) AS name, SUM(price) AS amt FROM sales_valid
      GROUP BY 1 ORDER BY amt DESC, name LIMIT 8)
UNION ALL
SELECT 'city', name, CAST(amt AS DOUBLE), CAST(row_number() OVER (ORDER BY amt DESC, name) AS INTEGER)
FROM (SELECT split_part(shipping_address, ' ', 1) || ' ' || substr(shipping_address, instr(shipping_address, ' ') + 1) AS name,
             SUM(price) AS amt FROM sales_valid WHERE contains(shipping_address, ' ')
      GROUP BY 1 ORDER BY amt DESC, name LIMIT 8)"""))
def ext_region_rank(spark, sf):
    return X.ext_region_rank(sales_valid(spark, sf)).select("level", "name", dbl("amt"), "rank")


@query("ext_category_growth", q("""
SELECT keyword, month, new_count, total_count,
       CASE WHEN total_count - new_count > 0 THEN new_count / (total_count - new_count) END AS growth
FROM (
  SELECT keyword, month, new_count,
         CAST(SUM(new_count) OVER (PARTITION BY keyword ORDER BY month ROWS UNBOUNDED PRECEDING) AS BIGINT)
           AS total_count
  FROM (SELECT keyword, date_trunc('month', "time") AS month, COUNT(*) AS new_count
        FROM sales_valid WHERE "time" IS NOT NULL GROUP BY 1, 2)
)"""))
def ext_category_growth(spark, sf):
    g = X.ext_category_growth(sales_valid(spark, sf))
    return g.select("keyword", ntz("month"), "new_count", F.col("total_count").cast("long")
                    .alias("total_count"), "growth")
