"""Catalogue entries answered by the live (streaming) run.

Each query triggers ``live_run`` once per application (memoized), then reads
one of its output tables as a batch DataFrame.  Their SQL twins are the plain
batch answers: the stream must equal the batch.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from salesboard.operators import measures as M
from salesboard.operators import serving as S
from salesboard.operators import state as ST
from salesboard.plans.catalog import dbl, ntz, query, ticks, ticks_valid
from salesboard.plans.oracle import q
from salesboard.schema import M_SHOP, M_TOTAL, M_TREND
from salesboard.sources import fixtures as FX
from salesboard.sources import topic as T
from salesboard.streaming.live import live_run
from salesboard.streaming.totals import latest_snapshot, read_snapshots, served_rows


def _live(spark, sf):
    return live_run(spark, ticks(spark, sf), key=sf)


def _state(spark, sf, measure=None):
    return ST.read_store(spark, _live(spark, sf).serving.checkpoint, measure)


# --- 2.1 sources, sinks, state access ------------------------------------------

@query("src_topic", q("""
SELECT topic, "partition", "offset", "timestamp", value FROM raw_ticks"""))
def src_topic(spark, sf):
    raw = spark.read.parquet(_live(spark, sf).paths["raw"])
    return raw.select("topic", "partition", "offset", ntz("timestamp"), "value")


@query("offset_ledger", q("""
SELECT topic, "partition", MAX("offset") + 1 AS next_offset FROM raw_ticks GROUP BY 1, 2"""))
def offset_ledger(spark, sf):
    ledger = ST.read_ledger(spark, _live(spark, sf).cfg.state_root)
    return T.latest_offsets(ledger)


@query("start_offsets", q("""
SELECT '{' || string_agg('"' || topic || '":' || p, ',' ORDER BY topic) || '}' AS starting_offsets
FROM (
  SELECT topic, '{' || string_agg('"' || CAST("partition" AS VARCHAR) || '":' || CAST(n AS VARCHAR),
                                  ',' ORDER BY "partition") || '}' AS p
  FROM (SELECT topic, "partition", MAX("offset") + 1 AS n FROM raw_ticks GROUP BY 1, 2)
  GROUP BY topic
)"""))
def start_offsets(spark, sf):
    ledger = ST.read_ledger(spark, _live(spark, sf).cfg.state_root)
    return T.start_offsets(T.latest_offsets(ledger))


_STATE_SQL = """
SELECT 'total' AS measure, '*' AS "key", CAST(SUM(price) AS DOUBLE) AS amt FROM ticks_valid
UNION ALL
SELECT 'shop', shop_id, CAST(amt AS DOUBLE) FROM shop_amt
UNION ALL
SELECT 'trend', strftime(bucket, '%Y-%m-%d %H:%M:%S'), CAST(amt AS DOUBLE) FROM trend"""


@query("upsert_add", q(_STATE_SQL))
def upsert_add(spark, sf):
    return _state(spark, sf).select("measure", "key", dbl("amt"))


@query("state_point_get", q("""
SELECT shop_id, CAST(amt AS DOUBLE) AS amt FROM shop_amt WHERE shop_id = '7'"""))
def state_point_get(spark, sf):
    published = ST.state_scan(spark, _live(spark, sf).paths["published"]).where(F.col("measure") == M_SHOP)
    return ST.state_point_get(published, "key", "7").select(F.col("key").alias("shop_id"), dbl("amt"))


@query("state_scan", q("""
SELECT shop_id, CAST(amt AS DOUBLE) AS amt FROM shop_amt"""))
def state_scan(spark, sf):
    shops = _state(spark, sf, M_SHOP)
    return shops.select(F.col("key").alias("shop_id"), dbl("amt"))


_METRICS_SQL = """
SELECT chunk AS batch_id, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE status IS NULL) AS n_valid,
       COUNT(*) FILTER (WHERE status IS NULL AND try_strptime("time", '%Y-%m-%d %H:%M:%S') IS NULL) AS n_bad_time,
       CAST(COALESCE(SUM(price) FILTER (WHERE status IS NULL), 0) AS DOUBLE) AS amt
FROM chunks GROUP BY chunk"""


@query("batch_metric", q(_METRICS_SQL))
def batch_metric(spark, sf):
    m = ST.read_metrics(spark, _live(spark, sf).cfg.state_root)
    return m.select("batch_id", "n_rows", "n_valid", "n_bad_time", dbl("amt"))


@query("skip_empty_batch", q("""
SELECT COUNT(*) AS n_batches_written, MAX(batch_id) AS last_batch_written FROM (""" + _METRICS_SQL + ")"))
def skip_empty_batch(spark, sf):
    # the run committed one more batch (the empty one) than it wrote
    m = ST.read_metrics(spark, _live(spark, sf).cfg.state_root)
    return m.agg(F.count("*").alias("n_batches_written"),
                 F.max("batch_id").alias("last_batch_written"))


@query("serve_total", q("""
SELECT CAST(COALESCE(SUM(price), 0) AS DOUBLE) AS total_amt FROM ticks_valid"""))
def serve_total(spark, sf):
    return S.serve_total(latest_snapshot(spark, _live(spark, sf).serving))


_RANKING_SQL = """
SELECT '[' || string_agg('{"shop_name":"' || shop_id || '","shop_amt_sum":' || CAST(amt AS VARCHAR) || '}',
                         ',' ORDER BY amt DESC, shop_id) || ']' AS ranking
FROM (SELECT MIN(shop_id) AS shop_id, CAST(amt AS DECIMAL(28,2)) AS amt FROM shop_amt GROUP BY amt
      ORDER BY amt DESC, shop_id LIMIT 5)"""


@query("serve_ranking", q(_RANKING_SQL))
def serve_ranking(spark, sf):
    # from the ordered index, which holds the best shops as of the newest batch
    best = served_rows(spark, _live(spark, sf).serving, M_SHOP).select(F.col("key").alias("shop_id"), "amt")
    return S.serve_ranking(best)


@query("serve_trend_point", q("""
SELECT '{"x_time":"' || strftime(bucket, '%Y-%m-%d %H:%M:%S') || '","time_amtSum":'
       || CAST(CAST(amt AS DOUBLE) AS VARCHAR) || '}' AS trend_point
FROM trend ORDER BY bucket DESC LIMIT 1"""))
def serve_trend_point(spark, sf):
    return latest_snapshot(spark, _live(spark, sf).serving).select("trend_point")


@query("serve_trend_point_lagged", q("""
SELECT e.event_id, strftime(e.p, '%Y-%m-%d %H:%M:%S') AS x_time, COALESCE(CAST(t.amt AS DOUBLE), 0.0) AS amt
FROM (SELECT event_id, date_trunc('second', CAST(ts AS TIMESTAMP) - INTERVAL 5 SECOND) AS p FROM events) e
LEFT JOIN trend t ON t.bucket = e.p"""))
def serve_trend_point_lagged(spark, sf):
    # every event's time as the clock: some lagged seconds have a point, most have none
    clocks = FX.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("now"))
    points = S.serve_trend_points(_state(spark, sf, M_TREND), clocks)
    return points.select("event_id", "x_time", F.col("time_amtSum").alias("amt"))


@query("quarantine", q("""
SELECT value, n_fields, status AS reason FROM ticks_parsed WHERE status IS NOT NULL
UNION ALL
SELECT value, n_fields, 'bad_time' FROM ticks_parsed
WHERE status IS NULL AND try_strptime("time", '%Y-%m-%d %H:%M:%S') IS NULL"""))
def quarantine(spark, sf):
    return ST.read_quarantine(spark, _live(spark, sf).cfg.state_root).select("value", "n_fields", "reason")


# --- 2.3 / 2.4 running measures -------------------------------------------------

@query("state_merge", q("""
SELECT shop_id, CAST(SUM(price) AS DOUBLE) AS amt FROM chunks
WHERE status IS NULL AND shop_id <> '' GROUP BY shop_id"""))
def state_merge(spark, sf):
    d = ST.read_deltas(spark, _live(spark, sf).cfg.state_root).where(F.col("measure") == M_SHOP)
    hist = d.where(F.col("batch_id") < 2).groupBy("key").agg(F.sum("delta").alias("amt"))
    new = d.where(F.col("batch_id") >= 2).groupBy("key").agg(F.sum("delta").alias("delta"))
    return ST.state_merge(hist, new).select(F.col("key").alias("shop_id"), dbl("amt"))


@query("running_total", q("""
SELECT CAST(SUM(price) AS DOUBLE) AS total_amt FROM ticks_valid"""))
def running_total(spark, sf):
    return _state(spark, sf, M_TOTAL).select(F.col("amt").cast("double").alias("total_amt"))


@query("running_shop_amt", q("""
SELECT shop_id, CAST(amt AS DOUBLE) AS amt FROM shop_amt"""))
def running_shop_amt(spark, sf):
    return _state(spark, sf, M_SHOP).select(F.col("key").alias("shop_id"), dbl("amt"))


@query("running_trend", q("""
SELECT bucket, CAST(amt AS DOUBLE) AS amt FROM trend"""))
def running_trend(spark, sf):
    return _state(spark, sf, M_TREND).select(F.to_timestamp("key").cast("timestamp_ntz").alias("bucket"), dbl("amt"))


# --- 2.8 streaming -----------------------------------------------------------------

@query("micro_batch", q("""
SELECT COUNT(DISTINCT chunk) AS n_batches, COUNT(*) AS n_rows FROM chunks"""))
def micro_batch(spark, sf):
    m = ST.read_metrics(spark, _live(spark, sf).cfg.state_root)
    return m.agg(F.count("*").alias("n_batches"), F.sum("n_rows").alias("n_rows"))


@query("fan_out", q("""
SELECT measure, COUNT(*) AS n_keys, CAST(SUM(amt) AS DOUBLE) AS amt FROM (""" + _STATE_SQL + """
) GROUP BY measure"""))
def fan_out(spark, sf):
    s = ST.read_state(spark, _live(spark, sf).cfg.state_root)     # the batch log added up
    return s.groupBy("measure").agg(F.count("*").alias("n_keys"), F.sum("amt").cast("double").alias("amt"))


@query("stateful_totals", q("""
SELECT CAST(SUM(price) AS DOUBLE) AS total_amt FROM ticks_valid"""))
def stateful_totals(spark, sf):
    return S.serve_total(_state(spark, sf, M_TOTAL), "amt")


@query("arrival_bucket", q("""
SELECT date_trunc('second', "timestamp" + ("offset" % 7) * INTERVAL 1 SECOND) AS bucket,
       CAST(SUM(price) AS DOUBLE) AS amt
FROM ticks_valid GROUP BY 1"""))
def arrival_bucket(spark, sf):
    # records arrive 0 to 6 seconds after their event time
    late = F.make_dt_interval(secs=(F.col("offset") % 7).cast("decimal(18,6)"))
    v = ticks_valid(spark, sf).withColumn("timestamp", F.col("timestamp") + late)
    return M.batch_trend(v, time_col="ingest").select(ntz("bucket"), dbl("amt"))


@query("replay_commit", q("""
SELECT CAST(SUM(price) AS DOUBLE) AS total_amt, COUNT(DISTINCT chunk) AS n_batches
FROM chunks WHERE status IS NULL"""))
def replay_commit(spark, sf):
    lr = _live(spark, sf)   # the last batch with rows ran twice
    d = ST.read_deltas(spark, lr.cfg.state_root)
    return d.agg(
        F.sum(F.when(F.col("measure") == M_TOTAL, F.col("delta"))).cast("double").alias("total_amt"),
        F.countDistinct("batch_id").alias("n_batches"))


@query("live_poll", q("""
SELECT chunk AS batch_id,
       CAST(SUM(SUM(price)) OVER (ORDER BY chunk) AS DOUBLE) AS total_amt
FROM chunks WHERE status IS NULL GROUP BY chunk"""))
def live_poll(spark, sf):
    s = read_snapshots(spark, _live(spark, sf).serving)
    return s.select("batch_id", "total_amt")


@query("series_append", q("""
SELECT bucket, CAST(amt AS DOUBLE) AS amt FROM trend
WHERE bucket + INTERVAL 1 SECOND <= (SELECT MAX("time") FROM ticks_valid) - INTERVAL 10 MINUTE"""))
def series_append(spark, sf):
    pts = spark.read.parquet(_live(spark, sf).paths["points"])
    return pts.select(ntz("bucket"), dbl("amt"))
