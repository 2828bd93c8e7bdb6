from decimal import Decimal

from pyspark.sql import functions as F

from salesboard.functions.scalar import price_low
from salesboard.operators.parse import parse_records, parse_sales, split_record

LINE = "2024-01-05 09:30:00^https://item.example/7^7^item 7^click^p1^{price}^25.00^1^R2 C4^{shop}^0^{name}"


def _line(price="19.90", shop="42", name="Shop 42"):
    return LINE.format(price=price, shop=shop, name=name)


def test_split_drops_trailing_empty_fields(spark):
    df = spark.createDataFrame([("a^b^^",), ("^a^b",), ("",), ("a^^b",), ("^^^",)], "value string")
    got = [r[0] for r in df.select(split_record("value")).collect()]
    assert got == [["a", "b"], ["", "a", "b"], [""], ["a", "", "b"], []]


def test_price_low_cases(spark):
    df = spark.createDataFrame([("-5",), ("1e-3",), ("n/a",), ("12.5 - 30",), (" 7 ",)], "p string")
    low = [r[0] for r in df.select(price_low("p")).collect()]
    assert low == ["", "1e", "n/a", "12.5", "7"]
    casted = [r[0] for r in df.select(price_low("p").try_cast("decimal(18,2)")).collect()]
    assert casted == [None, None, None, Decimal("12.50"), Decimal("7.00")]


def test_statuses_and_quarantine(spark):
    rows = [
        (_line(),),                               # ok
        ("x^y^id",),                              # 3 fields
        (_line(name=""),),                        # trailing field drops -> 12
        (_line(price="10 - 99999"),),             # range price -> 10
        (_line(shop=""),),                        # blank shop: valid
        (_line(price="n/a"),),                    # bad price
        (_line() + "^^^",),                       # trailing empties drop -> ok
        (_line() + "^x",),                        # 14 fields
        (_line(price="NaN"),),                    # non-finite -> bad price
    ]
    raw = spark.createDataFrame(rows, "value string")
    p = parse_records(raw).select("n_fields", "status", "price").collect()
    assert [r.status for r in p] == [None, "bad_arity", "bad_arity", None, None, "bad_price",
                                     None, "bad_arity", "bad_price"]
    assert [r.n_fields for r in p][:3] == [13, 3, 12]
    assert p[3].price == Decimal("10.00")
    valid, bad = parse_sales(raw)
    assert valid.count() == 4 and bad.count() == 5
    assert sorted(r.reason for r in bad.collect()) == ["bad_arity"] * 3 + ["bad_price"] * 2
    t = valid.select(F.col("time").cast("string")).first()[0]
    assert t == "2024-01-05 09:30:00"


def test_fixture_counts_sf001(spark):
    from salesboard.plans.catalog import ticks_parsed
    p = ticks_parsed(spark, "/root/testdata/sf0.01")
    counts = {r[0]: r[1] for r in p.groupBy("status").count().collect()}
    assert counts == {None: 9200, "bad_arity": 600, "bad_price": 200}
    total = p.where("status is null").agg(F.sum("price")).first()[0]
    assert total == Decimal("459865.61")
    shops = p.where("status is null and shop_id != ''").select("shop_id").distinct().count()
    assert shops == 150


def test_field_count_edge_lines(spark):
    df = spark.createDataFrame([("",), ("^^^",), ("a",), ("a^",), ("^a",)], "value string")
    got = [(r.n_fields, r.status) for r in parse_records(df).select("n_fields", "status").collect()]
    assert [n for n, _ in got] == [1, 0, 1, 1, 2]
    assert all(s == "bad_arity" for _, s in got)
