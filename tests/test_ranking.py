from pyspark.sql import functions as F
from pyspark.sql import Window

from salesboard.operators import ranking as R

AMTS = [("a", 10.0), ("b", 10.0), ("c", 9.0), ("d", 8.0), ("e", 7.0), ("f", 6.0)]


def _shops(spark):
    return spark.createDataFrame(AMTS, "shop_id string, amt double")


def test_tie_collapse(spark):
    got = [(r.shop_id, r.amt) for r in R.top_shops(_shops(spark)).collect()]
    assert got == [("a", 10.0), ("c", 9.0), ("d", 8.0), ("e", 7.0), ("f", 6.0)]


def test_tie_all(spark):
    got = [(r.shop_id, r.amt) for r in R.top_shops(_shops(spark), ties="all").collect()]
    assert got == [("a", 10.0), ("b", 10.0), ("c", 9.0), ("d", 8.0), ("e", 7.0)]


def test_byte_order_wins_ties(spark):
    df = spark.createDataFrame([("9", 5.0), ("10", 5.0)], "shop_id string, amt double")
    assert R.top_shops(df).first().shop_id == "10"     # "1" < "9" in byte order


def test_position_tier_cap(spark):
    top = R.top_shops(_shops(spark))
    ranked = R.rank_tier(R.rank_position(top)).orderBy("rank").collect()
    assert [r.rank for r in ranked] == [1, 2, 3, 4, 5]
    assert [r.tier for r in ranked] == ["gold", "silver", "bronze", None, None]
    assert R.rank_cap(_shops(spark)).count() == 6


def test_rank_in_groups_matches_window_on_skew(spark):
    # one group holds most rows; positions must equal a plain row_number
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise((F.col("id") % 13).cast("string")).alias("g"),
        (F.col("id") * 7919 % 1000).alias("v"), F.col("id").alias("k"))
    df = df.repartition(8)
    got = R.rank_in_groups(df, ["g"], [F.desc("v"), F.asc("k")])
    w = Window.partitionBy("g").orderBy(F.desc("v"), F.asc("k"))
    want = df.withColumn("rank", F.row_number().over(w))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
