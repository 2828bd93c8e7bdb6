import contextlib
import datetime as dt
import io
import json
from decimal import Decimal

from pyspark.sql import functions as F

from salesboard.operators import serving as S
from salesboard.operators import state as ST
from salesboard.session import fresh_dir


def test_empty_state_serves_zero(spark):
    empty_total = spark.createDataFrame([], "total_amt double")
    assert S.serve_total(empty_total).first()[0] == 0.0
    empty_shops = spark.createDataFrame([], "shop_id string, amt decimal(28,2)")
    assert S.serve_ranking(empty_shops).first()[0] == "[]"
    empty_trend = spark.createDataFrame([], "bucket timestamp, amt decimal(28,2)")
    pt = json.loads(S.serve_trend_point(empty_trend, dt.datetime(2024, 1, 5, 9, 30, 7)).first()[0])
    assert pt == {"x_time": "2024-01-05 09:30:02", "time_amtSum": 0.0}


def test_trend_point_hit_truncates_now(spark):
    trend = spark.createDataFrame([(dt.datetime(2024, 1, 5, 9, 30, 2), Decimal("12.50"))],
                                  "bucket timestamp, amt decimal(28,2)")
    pt = json.loads(S.serve_trend_point(trend, dt.datetime(2024, 1, 5, 9, 30, 7, 999000)).first()[0])
    assert pt["time_amtSum"] == 12.5


def test_ranking_json_shape(spark):
    shops = spark.createDataFrame([("a", Decimal("10.00")), ("b", Decimal("10.00")), ("c", Decimal("3.50"))],
                                  "shop_id string, amt decimal(28,2)")
    got = json.loads(S.serve_ranking(shops).first()[0])
    assert got == [{"shop_name": "a", "shop_amt_sum": 10.0}, {"shop_name": "c", "shop_amt_sum": 3.5}]


def _deltas(spark, rows):
    return spark.createDataFrame(rows, "measure string, key string, delta decimal(28,2)")


def test_upsert_add_is_idempotent(spark):
    root = fresh_dir(spark, "t-state")
    b0 = _deltas(spark, [("shop", "a", Decimal("1.00")), ("total", "*", Decimal("1.00"))])
    b1 = _deltas(spark, [("shop", "a", Decimal("2.00")), ("shop", "b", Decimal("5.00")),
                         ("total", "*", Decimal("7.00"))])
    ST.upsert_add(root, b0, "s", 0)
    ST.upsert_add(root, b1, "s", 1)
    ST.upsert_add(root, b1, "s", 1)          # replay of batch 1
    want = {("shop", "a"): Decimal("3.00"), ("shop", "b"): Decimal("5.00"), ("total", "*"): Decimal("8.00")}
    got = {(r.measure, r.key): r.amt for r in ST.read_state(spark, root).collect()}
    assert got == want
    assert {(r.measure, r.key): r.amt for r in ST.read_state(spark, root, up_to_batch=0).collect()} == \
        {("shop", "a"): Decimal("1.00"), ("total", "*"): Decimal("1.00")}
    ST.upsert_add(root, _deltas(spark, [("shop", "c", Decimal("1.00"))]), "s", 2)
    want[("shop", "c")] = Decimal("1.00")
    got = {(r.measure, r.key): r.amt for r in ST.read_state(spark, root).collect()}
    assert got == want
    per_batch = ST.read_deltas(spark, root).groupBy("batch_id").count().collect()
    assert sorted(r.batch_id for r in per_batch) == [0, 1, 2]


def test_state_merge_full_outer(spark):
    hist = spark.createDataFrame([("a", Decimal("1")), ("b", Decimal("2"))], "key string, amt decimal(28,2)")
    new = spark.createDataFrame([("b", Decimal("3")), ("c", Decimal("4"))], "key string, delta decimal(28,2)")
    got = {r.key: r.amt for r in ST.state_merge(hist, new).collect()}
    assert got == {"a": Decimal("1"), "b": Decimal("5"), "c": Decimal("4")}


def test_point_get_pushes_filter(spark):
    root = fresh_dir(spark, "t-point")
    spark.range(100).select(F.col("id").cast("string").alias("shop_id"),
                            F.col("id").cast("decimal(28,2)").alias("amt")).write.parquet(root)
    df = ST.state_point_get(ST.state_scan(spark, root), "shop_id", "7")
    assert df.collect()[0].amt == Decimal("7.00")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    assert "PushedFilters: [IsNotNull(shop_id), EqualTo(shop_id,7)]" in buf.getvalue()


def test_second_stream_loses_nothing(spark):
    """Batch ids restart at 0 with a new stream id; the first stream must not swallow them."""
    root = fresh_dir(spark, "two-streams")
    delta = spark.createDataFrame([("total", "*", Decimal("10.00"))], "measure string, key string, delta decimal(18,2)")
    for stream in ("a", "b"):
        for b in (0, 1):
            ST.upsert_add(root, delta, stream, b)
    assert ST.read_state(spark, root, "total").first().amt == 40
    ST.upsert_add(root, delta, "b", 1)       # a replay
    assert ST.read_state(spark, root, "total").first().amt == 40


def test_offsets_do_not_go_back_across_streams(spark):
    from salesboard.sources.topic import latest_offsets
    ledger = spark.createDataFrame([("t", 0, 100, "a", 99), ("t", 0, 150, "b", 3)],
                                   "topic string, partition int, next_offset long, stream_id string, batch_id long")
    assert latest_offsets(ledger).first().next_offset == 150
