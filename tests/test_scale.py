"""Skew and batching properties: a hot key, and results independent of batch cuts."""

import contextlib
import io
from decimal import Decimal

from pyspark.sql import functions as F

from salesboard.operators import measures as M
from salesboard.operators import state as ST
from salesboard.operators.parse import parse_sales
from salesboard.session import fresh_dir
from salesboard.sources.logs import raw_log
from salesboard.streaming.job import JobConfig, batch_log, process_batch, slim_batch

from paths import SF_SMALL

ENVELOPE = ["topic", "partition", "offset", "timestamp", "value"]


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _hot_log(spark):
    """A third of all records belong to one shop."""
    log = raw_log(spark, SF_SMALL, "ticks")
    hot = F.when(F.col("ordinal") % 3 == 0,
                 F.regexp_replace("value", r"\^(\d+)\^(\d+)\^Shop (\d+)$", "^HOT^$2^Shop HOT"))
    return log.withColumn("value", F.coalesce(hot, F.col("value")))


def test_hot_shop_is_pre_aggregated(spark):
    valid, _ = parse_sales(_hot_log(spark))
    shops = M.batch_shop_amt(valid)
    plan = _plan(shops)
    assert "partial_sum" in plan                       # map-side combine before the shuffle
    got = {r.shop_id: r.amt for r in shops.collect()}
    want = {r.shop_id: r.amt for r in valid.where("shop_id != ''").groupBy("shop_id")
            .agg(F.sum("price").alias("amt")).collect()}
    assert got == want and "HOT" in got


def test_batch_log_is_one_partial_aggregation(spark):
    slim = slim_batch(_hot_log(spark).select(*ENVELOPE))
    plan = _plan(batch_log(slim))
    assert plan.count("Exchange hashpartitioning") == 1   # one shuffle for every per-batch output
    assert "partial_sum" in plan and "partial_max" in plan
    assert plan.count("Expand") == 1                      # four grouping sets a record, and no array of eight


def _state_after_cuts(spark, n_cuts):
    root = fresh_dir(spark, f"t-cuts{n_cuts}")
    cfg = JobConfig(state_root=root, stream_id="c")
    log = raw_log(spark, SF_SMALL, "ticks")
    cut = F.col("ordinal") % n_cuts                       # rows interleaved across batches
    for b in range(n_cuts):
        process_batch(log.where(cut == b).select(*ENVELOPE), b, cfg)
    return {(r.measure, r.key): r.amt for r in ST.read_state(spark, root).collect()}


def test_state_independent_of_batch_cuts(spark):
    a, b = _state_after_cuts(spark, 2), _state_after_cuts(spark, 5)
    assert a == b
    total = a[("total", "*")]
    assert total > sum(v for (m, _), v in a.items() if m == "trend") > Decimal(0)      # rows with a bad time are in the total alone
    assert total >= sum(v for (m, _), v in a.items() if m == "shop") > Decimal(0)
