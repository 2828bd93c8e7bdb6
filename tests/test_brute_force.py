"""End-to-end check against a brute-force Python model on the smallest tables.

The model rebuilds every record line from ``events`` by the fixture rules,
parses it with the upstream split rules and sums the three measures; Spark's
fixture + parser + measures must give the same numbers.
"""

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

import pyarrow.parquet as pq

from salesboard.operators import measures as M
from salesboard.plans.catalog import ticks_valid

from paths import SF_SMALL
from test_parse_properties import java_split, model_price_low


def _money(v: float) -> str:
    return str(Decimal(repr(v)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def _line(e) -> str:
    eid, uid = e["event_id"], e["user_id"]
    rest, pid, price = eid % 50, str(eid % 97), _money(e["value"])
    fields = [
        e["ts"].strftime("%Y-13-%d %H:%M:%S" if rest == 7 else "%Y-%m-%d %H:%M:%S"), "https://item.example/" + pid, pid, "item " + pid,
        e["event_type"], "p" + str(eid % 7 + 1),
        price + " - 99999" if rest == 2 else "n/a" if rest == 4 else price,
        price, str(eid % 5 + 1), f"R{uid % 5} C{uid % 23}",
        "" if rest == 3 else str(uid), str(eid % 11), "" if rest == 1 else f"Shop {uid}",
    ]
    line = "^".join(fields)
    return {0: "x^y^id", 5: line + "^^^", 6: line + "^x"}.get(rest, line)


def _model():
    total, shops, trend = Decimal(0), defaultdict(Decimal), defaultdict(Decimal)
    for e in pq.read_table(f"{SF_SMALL}/events.parquet").to_pylist():
        f = java_split(_line(e), "^")
        if len(f) != 13:
            continue
        try:
            p = Decimal(model_price_low(f[6])).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        except InvalidOperation:
            continue
        total += p
        if f[0][5:7] != "13":
            trend[f[0]] += p
        if f[10] != "":
            shops[f[10]] += p
    return total, dict(shops), dict(trend)


def test_measures_equal_brute_force(spark):
    total, shops, trend = _model()
    valid = ticks_valid(spark, SF_SMALL)
    assert M.batch_total(valid).first()[0] == total
    assert {r.shop_id: r.amt for r in M.batch_shop_amt(valid).collect()} == shops
    got = {r.bucket.strftime("%Y-%m-%d %H:%M:%S"): r.amt for r in M.batch_trend(valid).collect()}
    assert got == trend
