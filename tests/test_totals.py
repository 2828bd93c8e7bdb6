"""The totals query: ordered index, slots, replay after a crash, second streams, admission control."""

import json
import os
import random
import shutil
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesboard.operators import measures as M
from salesboard.operators import state as ST
from salesboard.operators.ranking import top_shops
from salesboard.operators.ranking_index import advance
from salesboard.plans.catalog import ticks, ticks_valid
from salesboard.session import conf_override, fresh_dir
from salesboard.sources.topic import read_envelope_files
from salesboard.streaming import totals as T
from salesboard.streaming.feeder import Feeder
from salesboard.streaming.live import ENVELOPE_COLUMNS

from paths import SF_SMALL

AMOUNTS = "key string, amt decimal(28,2)"


def _frame(spark, amounts):
    return spark.createDataFrame([(k, Decimal(v)) for k, v in amounts.items()], AMOUNTS)


def _top(shops, k):
    return [tuple(r) for r in top_shops(shops, k, key="key").collect()]


@pytest.mark.parametrize("seed", range(2))
def test_index_equals_top_shops_under_ties_and_decreases(spark, seed):
    rng = random.Random(seed)
    everything: dict[str, int] = {}
    index, floor, filled = spark.createDataFrame([], AMOUNTS), None, 0
    for step in range(12):
        touched = {f"s{rng.randrange(60)}": rng.randrange(40) for _ in range(rng.choice([1, 5, 25]))}
        if step in (5, 9):                                        # the best shops fall: the index runs dry
            touched = {k: rng.randrange(3) for k, v in everything.items() if v >= 10}
        before = _frame(spark, everything) if everything else spark.createDataFrame([], AMOUNTS)
        everything.update(touched)
        index, floor, again = advance(index, floor, _frame(spark, touched), lambda b=before: b, k=3, keep=4)
        rows = index.collect()
        filled += again
        index = spark.createDataFrame(rows, AMOUNTS)
        # every shop from the floor up, and no other
        assert {r.key: int(r.amt) for r in rows} == {k: v for k, v in everything.items() if floor is None or v >= floor}
        assert _top(index, 3) == _top(_frame(spark, everything), 3)
        assert len({r.amt for r in rows}) <= 2 * 4
    assert filled >= 1


def test_a_batch_reads_only_the_shops_it_touched(spark):
    """With a full index and rising amounts, all shops are never asked for."""
    def never():
        raise AssertionError("the index was filled again")
    shops = _frame(spark, {f"s{n}": n for n in range(500)})
    index, floor, _ = advance(spark.createDataFrame([], AMOUNTS), None, shops, never)
    assert floor == 500 - 64 and index.count() == 64
    touched = {f"s{n}": 10_000 + n for n in range(0, 500, 100)}
    index, _, again = advance(index, floor, _frame(spark, touched), never)
    assert not again and [k for k, _ in _top(index, 5)] == ["s400", "s300", "s200", "s100", "s0"]


def _feed(spark, root, n=3):
    return Feeder(spark, ticks(spark, SF_SMALL), f"{root}/staging", f"{root}/source", n, keep=ENVELOPE_COLUMNS)


def _local(path):
    return path.removeprefix("file:")


def test_crash_before_the_commit_and_a_second_stream(spark):
    """A batch whose commit is lost runs again: state, slots and snapshots stay as they were."""
    root = fresh_dir(spark, "t-crash")
    cfg = T.ServingConfig(root=f"{root}/serving", checkpoint=f"{root}/ck", keep=5)
    feeder = _feed(spark, root)
    with conf_override(spark, {"spark.sql.shuffle.partitions": "4"}):
        for k in range(3):
            feeder.publish(k)                                     # a backlog: taken two files a batch
        q = T.run_totals(read_envelope_files(spark, feeder.source, feeder.files), cfg)
        q.awaitTermination()
        assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]] == [feeder.chunk(k).count() for k in range(3)]
        once = {tuple(r) for r in ST.read_store(spark, cfg.checkpoint).collect()}
        snaps = [tuple(r) for r in T.read_snapshots(spark, cfg).orderBy("batch_id").collect()]
        rows = {tuple(r) for r in T.served_rows(spark, cfg).collect()}
        for name in ("2", ".2.crc"):
            if os.path.exists(p := f"{_local(cfg.checkpoint)}/commits/{name}"):
                os.remove(p)
        T.run_totals(read_envelope_files(spark, feeder.source, feeder.files), cfg).awaitTermination()
        assert {tuple(r) for r in ST.read_store(spark, cfg.checkpoint).collect()} == once
        assert [tuple(r) for r in T.read_snapshots(spark, cfg).orderBy("batch_id").collect()] == snaps
        assert {tuple(r) for r in T.served_rows(spark, cfg).collect()} == rows
        # as of an earlier batch
        first = ST.read_store(spark, cfg.checkpoint, "total", batch_id=0).first().amt
        assert float(first) == pytest.approx(snaps[0][0])
        # the slots are lost: the next batch makes them again from the state store
        shutil.rmtree(_local(cfg.slot(0)))
        shutil.rmtree(_local(cfg.slot(1)))
        feeder.publish(0)
        T.run_totals(read_envelope_files(spark, feeder.source, feeder.files), cfg).awaitTermination()
        shops = ST.read_store(spark, cfg.checkpoint, "shop").select("key", "amt")
        best = T.served_rows(spark, cfg, "shop").select("key", "amt")
        assert _top(best, 5) == _top(shops, 5) and best.count() < shops.count()
        assert T.latest_snapshot(spark, cfg).first().batch_id == 3
        # a second stream has a state of its own
        other = T.ServingConfig(root=f"{root}/serving2", checkpoint=f"{root}/ck2")
        T.run_totals(read_envelope_files(spark, feeder.source), other).awaitTermination()
    both = {r.key: r.amt for r in ST.read_store(spark, other.checkpoint, "shop").collect()}
    assert both == {r.key: r.amt for r in shops.collect()}


def test_served_points_of_a_wall_clock(spark):
    """A second older than those kept comes from the touched rows; an unknown one is 0.0."""
    cfg = T.ServingConfig(root=fresh_dir(spark, "t-wall"), checkpoint="none", clock="wall", lag_seconds=0)
    now = spark.sql("SELECT date_format(current_timestamp(), 'yyyy-MM-dd HH:mm:ss')").first()[0]
    rows = [("total", "*", Decimal(3)), ("shop", "a", Decimal(3)), ("trend", "2999-01-01 00:00:00", Decimal(1)), ("trend", "2020-01-01 00:00:00", Decimal(2))]
    T.serve_batch(spark.createDataFrame(rows, T.SLOT_SCHEMA), 0, cfg)
    point = json.loads(T.latest_snapshot(spark, cfg).first().trend_point)
    assert point["time_amtSum"] == 0.0 and point["x_time"] >= now
    assert {r.key for r in T.served_rows(spark, cfg, "trend").collect()} == {"2999-01-01 00:00:00"}


def test_state_reads_do_not_grow_with_batches(spark):
    """The state is one read of the store, whatever number of batches made it."""
    valid = ticks_valid(spark, SF_SMALL)
    root = fresh_dir(spark, "t-many")
    cfg = T.ServingConfig(root=f"{root}/serving", checkpoint=f"{root}/ck")
    feeder = _feed(spark, root, 4)
    for k in range(4):
        feeder.publish(k)
    with conf_override(spark, {"spark.sql.shuffle.partitions": "2"}):
        T.run_totals(read_envelope_files(spark, feeder.source, feeder.files), cfg).awaitTermination()
    store = ST.read_store(spark, cfg.checkpoint, "shop")
    assert store.rdd.getNumPartitions() == 2                      # state partitions, not batches
    assert {r.key: r.amt for r in store.collect()} == {r.shop_id: r.amt for r in M.batch_shop_amt(valid).collect()}
