"""Plan properties that matter at scale, checked on the physical plans."""

import contextlib
import io
import re

import pytest

from paths import SF_SMALL


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _exchanges(df):
    """The columns that every exchange of a plan takes in, one text for each, and what it deals by."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    nodes = [n for n in buf.getvalue().split("\n\n") if ") Exchange" in n.splitlines()[0]]
    return [(re.search(r"Input \[\d+\]: (.*)", n)[1], re.search(r"Arguments: (.*)", n)[1]) for n in nodes]


def _queries():
    import __spark_entry__ as E
    return E.queries()


@pytest.mark.parametrize("name", sorted(_queries()))
def test_no_pairwise_joins(spark, name):
    plan = _plan(_queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_parse_reads_only_the_line(spark):
    plan = _plan(_queries()["batch_shop_amt"](spark, SF_SMALL))
    assert "ReadSchema: struct<value:string>" in plan
    assert "partial_sum" in plan


def test_rankings_are_bounded_top_k(spark):
    for name in ("top_shops", "rank_cap", "series_last_n", "ext_top_products"):
        assert "TakeOrderedAndProject" in _plan(_queries()[name](spark, SF_SMALL)), name


def test_slice_and_point_get_reach_the_scan(spark):
    plan = _plan(_queries()["log_slice"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(ordinal,1000)" in plan and "LessThan(ordinal,3500)" in plan
    plan = _plan(_queries()["state_point_get"](spark, SF_SMALL))
    assert "EqualTo(key,7)" in plan


def _scan_rows(df):
    """Rows that the file scans of an executed query gave out."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    rows, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan"):
            rows += node.metrics().get("numOutputRows").get().value()
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        todo += [node.children().apply(k) for k in range(node.children().size())]
    return rows


def test_a_slice_of_the_log_reads_its_own_row_groups(spark, monkeypatch):
    from paths import SF_MID
    from salesboard.streaming.feeder import log_slice
    from salesboard.sources.logs import raw_log
    log = raw_log(spark, SF_MID, "ticks")
    whole = log.select("ordinal", "value")
    assert len(whole.collect()) == _scan_rows(whole) == 10_000
    part = log_slice(log, 1000, 500).select("ordinal", "value")
    assert len(part.collect()) == 500
    assert _scan_rows(part) <= 2 * 10_000 // 8 + 500        # at most two of the eight ranges


def test_top_shops_sorts_no_table_of_all_shops(spark):
    """The smallest id is taken among the shops with the k best amounts only: the sort aggregate is above the semi join."""
    plan = _plan(_queries()["top_shops"](spark, SF_SMALL))
    semi = plan.index("LeftSemi")
    assert plan.count("SortAggregate") == 2 and plan.rindex("SortAggregate") < semi
    assert "SortAggregate" not in _plan(_queries()["series_peak"](spark, SF_SMALL))


def test_the_sales_log_shuffles_no_line_and_no_long_text_of_a_joined_row(spark):
    from salesboard.session import conf_override
    from salesboard.sources.logs import BUILDERS
    with conf_override(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "10000"}):
        made = _exchanges(BUILDERS["sales"](spark, SF_SMALL))
        rows = [cols for cols, _ in made if "l_linenumber" in cols]
    assert len(rows) == 3 and not any(by.startswith("rangepartitioning") for _, by in made)
    assert not any(text in cols for cols in rows for text in ("p_name", "p_type", "value", "r_name"))


def test_the_ticks_log_deals_events_not_lines(spark):
    from salesboard.sources.logs import BUILDERS
    (cols, by), = _exchanges(BUILDERS["ticks"](spark, SF_SMALL))
    assert by.startswith("rangepartitioning(ordinal") and "event_id" in cols and "topic" not in cols
