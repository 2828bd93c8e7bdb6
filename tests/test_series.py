"""The dense axis against a second by second model."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from salesboard.operators import series as SE

UTC = dt.timezone.utc


def _axis(points, step, extra):
    days = sorted({t.replace(hour=0, minute=0, second=0) for t in points})
    out = {}
    for day in days:
        for i in range((86_400 + extra) // step + 1):
            lo = day + dt.timedelta(seconds=i * step)
            held = [v for t, v in points.items() if lo <= t < lo + dt.timedelta(seconds=step)]
            if held:
                out[day, i] = (lo, sum(held))
    return days, out


@pytest.mark.parametrize("step, extra", [(1, 100), (300, 100), (3600, 0), (7, 100)])
def test_dense_axis(spark, step, extra):
    rng = random.Random(step)
    start = dt.datetime(2024, 2, 27, tzinfo=UTC)
    points = {start + dt.timedelta(seconds=s): Decimal(rng.randint(1, 99)) for s in
              [0, 86_399, 86_400, 86_499, 86_500, 86_501, 86_700, 3 * 86_400 + 50, 6 * 86_400 - 1, *(rng.randrange(2 * 86_400) for _ in range(40))]}
    df = spark.createDataFrame([(t, v) for t, v in points.items()], "bucket timestamp, amt decimal(28,2)").repartition(3)
    axis = SE.dense_axis(df, step, extra)
    days, want = _axis(points, step, extra)
    n = (86_400 + extra) // step + 1
    assert {tuple(r) for r in axis.groupBy("day").agg({"idx": "max", "*": "count"}).select("max(idx)", "count(1)").collect()} == {(n - 1, n)}
    got = {(r.day, r.idx): (r.bucket, r.amt) for r in axis.where("amt is not null").collect()}
    plain = lambda t: t.astimezone(UTC).replace(tzinfo=None)
    assert {(plain(d.astimezone()) , i): (plain(b.astimezone()), a) for (d, i), (b, a) in got.items()} == \
        {(plain(d), i): (plain(b), a) for (d, i), (b, a) in want.items()}
    assert axis.select("day").distinct().count() == len(days)
    assert SE.dense_axis(df, step, extra, fill=0).where("amt is null").isEmpty()


def test_peak_ties_take_the_earliest(spark):
    rows = [(dt.datetime(2024, 1, 1, 5), 3.0), (dt.datetime(2024, 1, 1, 4), 3.0), (dt.datetime(2024, 1, 1, 3), 1.0), (dt.datetime(2024, 1, 2), -1.0)]
    got = SE.series_peak(spark.createDataFrame(rows, "bucket timestamp, amt double")).collect()
    assert {(r.peak_bucket, r.peak_amt) for r in got} == {(rows[1][0], 3.0), (rows[3][0], -1.0)}
