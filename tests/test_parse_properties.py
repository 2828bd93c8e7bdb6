"""Property test: the parser against a direct model of the upstream split rules."""

from hypothesis import given, settings
from hypothesis import strategies as st

from salesboard.functions.scalar import price_low
from salesboard.operators.parse import parse_records, split_record


def java_split(s: str, sep: str) -> list[str]:
    """String.split with a literal one-character separator: trailing empties drop."""
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def model_price_low(p: str) -> str:
    if "-" in p:
        parts = java_split(p, "-")
        return parts[0].strip() if parts else ""
    return p.strip()


LINES = st.lists(st.text(alphabet="ab^- 1.", max_size=24), min_size=1, max_size=200)


@settings(max_examples=6, deadline=None)
@given(LINES)
def test_split_and_count_match_the_model(spark, lines):
    df = spark.createDataFrame([(s,) for s in lines], "value string")
    got = df.select(split_record("value").alias("f")).collect()
    counts = parse_records(df).select("n_fields").collect()
    for s, row, cnt in zip(lines, got, counts):
        want = java_split(s, "^")
        assert row.f == want, s
        assert cnt.n_fields == len(want), s


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="1.- ab", max_size=12), min_size=1, max_size=200))
def test_price_low_matches_the_model(spark, prices):
    df = spark.createDataFrame([(p,) for p in prices], "p string")
    got = [r[0] for r in df.select(price_low("p")).collect()]
    for p, g in zip(prices, got):
        assert g == model_price_low(p), p
