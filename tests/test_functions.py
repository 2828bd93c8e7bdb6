import datetime as dt

from pyspark.sql import functions as F

from salesboard.functions import scalar as fn


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()[0]


def test_parse_time(spark):
    assert one(spark, fn.parse_time_ms(F.lit("bad"))) == -1
    assert one(spark, fn.parse_time_ms(F.lit("2018-13-01 10:10:00"))) == -1   # strict
    assert one(spark, fn.parse_time_ms(F.lit("2018-03-01 10:10:00"))) == 1519899000000


def test_reverse_key(spark):
    ts = dt.datetime(2018, 3, 1, 10, 10, 0)
    assert one(spark, fn.reverse_key(F.lit(ts))) == "0000009989151"
    # lookup key is truncated to the second, so a millisecond "now" still hits
    ts_ms = F.lit("2018-03-01 10:10:00.123").cast("timestamp")
    assert one(spark, fn.reverse_key(ts_ms)) == "0000009989151"


def test_money(spark):
    assert one(spark, fn.money(F.lit(1323833.09))) == "1,323,833.09"
    assert one(spark, fn.money(F.lit(-1.0))) == "invalid value"
    assert one(spark, fn.money(F.lit(0.5))) == "0.50"


def test_zero_pad_keeps_last_chars(spark):
    assert one(spark, fn.zero_pad(F.lit(7), 2)) == "07"
    assert one(spark, fn.zero_pad(F.lit(123), 2)) == "23"


def test_hour_label(spark):
    assert one(spark, fn.hour_label(F.lit("00"), F.lit(0))) == "00"
    assert one(spark, fn.hour_label(F.lit("00"), F.lit(24))) == "24"
    assert one(spark, fn.hour_label(F.lit("13"), F.lit(13))) == "13"


def test_lagged_now_and_formats(spark):
    now = dt.datetime(2024, 1, 5, 9, 30, 7, 250000)
    assert one(spark, fn.format_time(fn.lagged_now(F.lit(now)))) == "2024-01-05 09:30:02"
    assert one(spark, fn.compact_time(F.lit(now), 1500)) == "20240105-09:30:05"
    assert one(spark, fn.clock_part(F.lit(now))) == "09:30:07"


def test_round0(spark):
    assert one(spark, fn.round0(F.lit(2.5).cast("decimal(10,2)"))) == 3
