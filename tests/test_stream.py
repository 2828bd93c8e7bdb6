"""Stream = batch, replay safety, empty batches, and measure properties."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesboard.operators import measures as M
from salesboard.operators import state as ST
from salesboard.plans.catalog import ticks, ticks_valid
from salesboard.operators.serving import serve_ranking
from salesboard.streaming.live import live_run
from salesboard.streaming.totals import latest_snapshot, read_snapshots

from paths import SF_SMALL


@pytest.fixture(scope="module")
def live(spark):
    return live_run(spark, ticks(spark, SF_SMALL), key="test:" + SF_SMALL)


def _as_dict(rows, k, v):
    return {getattr(r, k): getattr(r, v) for r in rows}


def test_stream_equals_batch(spark, live):
    valid = ticks_valid(spark, SF_SMALL)
    total = M.batch_total(valid).first()[0]
    shops = _as_dict(M.batch_shop_amt(valid).collect(), "shop_id", "amt")
    trend = {r.bucket.strftime("%Y-%m-%d %H:%M:%S"): r.amt for r in M.batch_trend(valid).collect()}
    state = ST.read_state(spark, live.cfg.state_root).collect()
    assert {r.key: r.amt for r in state if r.measure == "total"} == {"*": total}
    assert {r.key: r.amt for r in state if r.measure == "shop"} == shops
    assert {r.key: r.amt for r in state if r.measure == "trend"} == trend
    store = ST.read_store(spark, live.serving.checkpoint).collect()
    assert {(r.measure, r.key): r.amt for r in store} == {(r.measure, r.key): r.amt for r in state}
    assert len(store) == len(state)
    published = ST.state_scan(spark, live.paths["published"]).collect()
    assert {tuple(r) for r in published} == {tuple(r) for r in store}


def test_replay_did_not_double_count(spark, live):
    d = ST.read_deltas(spark, live.cfg.state_root)
    per_batch = d.where("measure = 'total'").groupBy("batch_id").count().collect()
    assert all(r[1] == 1 for r in per_batch)            # one total row per batch, replay included
    m = ST.read_metrics(spark, live.cfg.state_root).agg(F.sum("n_rows")).first()[0]
    assert m == ticks(spark, SF_SMALL).count()


def test_empty_batch_skipped(spark, live):
    written = ST.read_metrics(spark, live.cfg.state_root).select("batch_id").distinct().count()
    assert live.batches_committed == written + 1


def test_properties(spark, live):
    s = ST.read_state(spark, live.cfg.state_root)
    agg = {r.measure: r.amt for r in s.groupBy("measure").agg(F.sum("amt").alias("amt")).collect()}
    valid = ticks_valid(spark, SF_SMALL)
    timeless = valid.where("time is null").agg(F.sum("price")).first()[0]
    assert timeless > 0 and agg["total"] - agg["trend"] == timeless
    bad = ST.read_quarantine(spark, live.cfg.state_root).where("reason = 'bad_time'").count()
    assert bad == valid.where("time is null").count() == ST.read_metrics(spark, live.cfg.state_root).agg(F.sum("n_bad_time")).first()[0] > 0
    blank = valid.where("shop_id = ''").agg(F.sum("price")).first()[0] or Decimal(0)
    assert agg["total"] - agg["shop"] == blank


def test_live_poll_is_cumulative(spark, live):
    snaps = read_snapshots(spark, live.serving).orderBy("batch_id").collect()
    metrics = ST.read_metrics(spark, live.cfg.state_root).orderBy("batch_id").collect()
    run = Decimal(0)
    assert [s.batch_id for s in snaps] == [m.batch_id for m in metrics] == [0, 1, 2, 3]
    assert not any(s.refilled for s in snaps)
    for s, m in zip(snaps, metrics):
        run += m.amt
        assert abs(s.total_amt - float(run)) < 1e-6


def test_late_rows_leave_native_trend_not_delta_log(spark):
    """Arrivals out of order: the newest range first, then the oldest.

    The oldest rows are later than the 10-minute watermark by then, so the
    state-store trend drops them; the delta log still counts every row.
    """
    from salesboard.session import fresh_dir
    from salesboard.sources.topic import read_envelope_files
    from salesboard.streaming.feeder import Feeder
    from salesboard.streaming.job import JobConfig, run
    from salesboard.streaming import native as N
    from salesboard.streaming.live import ENVELOPE_COLUMNS

    root = fresh_dir(spark, "t-late")
    feeder = Feeder(spark, ticks(spark, SF_SMALL), f"{root}/staging", f"{root}/source", 2,
                    keep=ENVELOPE_COLUMNS)
    cfg = JobConfig(state_root=f"{root}/state", stream_id="late")
    for k in (1, 0):
        feeder.publish(k)
        raw = read_envelope_files(spark, feeder.source)
        for q in (run(raw, cfg, f"{root}/ck-job"),
                  N.upsert_sink(N.native_trend(N.valid_stream(raw)), f"{root}/trend", f"{root}/ck-trend")):
            q.awaitTermination()
    batch = {r.bucket: r.amt for r in M.batch_trend(ticks_valid(spark, SF_SMALL)).collect()}
    logged = ST.read_state(spark, cfg.state_root, "trend").collect()
    assert len(logged) == len(batch)
    native = spark.read.parquet(f"{root}/trend").select("bucket").distinct().count()
    assert 0 < native < len(batch)


def test_replay_of_any_batch_keeps_state(spark):
    from salesboard.session import fresh_dir
    from salesboard.sources.logs import raw_log
    from salesboard.streaming.job import JobConfig, process_batch

    root = fresh_dir(spark, "t-replay")
    cfg = JobConfig(state_root=root, stream_id="c")
    log = raw_log(spark, SF_SMALL, "ticks")
    env = ["topic", "partition", "offset", "timestamp", "value"]
    for b in range(3):
        process_batch(log.where(F.col("ordinal") % 3 == b).select(*env), b, cfg)
    valid = ticks_valid(spark, SF_SMALL)
    got = {r.key: r.amt for r in ST.read_state(spark, root, "shop").collect()}
    assert got == _as_dict(M.batch_shop_amt(valid).collect(), "shop_id", "amt")
    # a replay of an old batch changes nothing
    process_batch(log.where(F.col("ordinal") % 3 == 1).select(*env), 1, cfg)
    assert {r.key: r.amt for r in ST.read_state(spark, root, "shop").collect()} == got


def test_processing_time_buckets_one_second_per_batch(spark):
    from salesboard.session import fresh_dir
    from salesboard.sources.logs import raw_log
    from salesboard.streaming.job import JobConfig, process_batch

    root = fresh_dir(spark, "t-proc")
    cfg = JobConfig(state_root=root, stream_id="p", time_col="processing")
    env = ["topic", "partition", "offset", "timestamp", "value"]
    process_batch(raw_log(spark, SF_SMALL, "ticks").select(*env), 0, cfg)
    trend = ST.read_state(spark, root, "trend").collect()
    total = ST.read_state(spark, root, "total").first().amt
    assert len(trend) == 1 and trend[0].amt == total


def test_latest_snapshot(spark, live):
    import json
    snap = latest_snapshot(spark, live.serving).first()
    total = float(M.batch_total(ticks_valid(spark, SF_SMALL)).first()[0])
    assert snap.batch_id == 3 and abs(snap.total_amt - total) < 1e-6      # batch 4 was empty
    shops = M.batch_shop_amt(ticks_valid(spark, SF_SMALL))
    assert json.loads(snap.ranking) == json.loads(serve_ranking(shops).first()[0]) and len(json.loads(snap.ranking)) == 5


def test_a_bad_time_is_quarantined_and_counted(spark):
    from salesboard.session import fresh_dir
    from salesboard.streaming.job import JobConfig, process_batch

    root = fresh_dir(spark, "t-bad-time")
    cfg = JobConfig(state_root=root, stream_id="x")
    def line(time):
        return "^".join([time, "u", "7", "n", "k", "p1", "19.90", "19.90", "1", "R1 C4", "5", "0", "Shop 5"])
    rows = [("sales", 0, 0, None, line("2020-13-01 00:00:00")), ("sales", 0, 1, None, line("2020-12-01 00:00:00"))]
    process_batch(spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp timestamp, value string"), 0, cfg)
    state = {(r.measure, r.key): r.amt for r in ST.read_state(spark, root).collect()}
    assert state == {("total", "*"): Decimal("39.80"), ("shop", "5"): Decimal("39.80"), ("trend", "2020-12-01 00:00:00"): Decimal("19.90")}
    assert [(r.value, r.reason) for r in ST.read_quarantine(spark, root).collect()] == [(rows[0][4], "bad_time")]
    m = ST.read_metrics(spark, root).first()
    assert (m.n_rows, m.n_valid, m.n_bad, m.n_bad_time) == (2, 2, 0, 1)


def test_snapshot_serves_the_lagged_point(spark):
    import json
    from datetime import datetime

    from salesboard.operators.serving import serving_snapshot
    state = spark.createDataFrame([("total", "*", 3.0), ("trend", "2020-12-01 00:00:01", 2.0), ("trend", "2020-12-01 00:00:09", 1.0)],
                                  "measure string, key string, amt double")
    def served(second):
        now = F.lit(datetime(2020, 12, 1, 0, 0, second)).cast("timestamp")
        return json.loads(serving_snapshot(state, now=now).first().trend_point)
    assert served(6) == {"x_time": "2020-12-01 00:00:01", "time_amtSum": 2.0}
    assert served(7) == {"x_time": "2020-12-01 00:00:02", "time_amtSum": 0.0}


def test_batch_metric_has_time_and_amount(spark, live):
    rows = ST.read_metrics(spark, live.cfg.state_root).orderBy("batch_id").collect()
    assert all(r.batch_time is not None for r in rows)
    assert [r.batch_time for r in rows] == sorted(r.batch_time for r in rows)
    assert all(r.n_rows == r.n_valid + r.n_bad for r in rows)
