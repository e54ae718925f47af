"""Plan shape: no pair-emitting joins, no COUNT DISTINCT expansion where the
survey replaced it, one pass over clicks in the breakdowns, date filters at the scan."""

import pytest

from adlens.plans.catalog import catalog
from adlens.plans.inspect import operators, plan_text, pushed_filters, scans_of
from tests.conftest import SF_SMALL

PYTHON_NODES = {"BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas",
                "FlatMapCoGroupsInPandas", "AggregateInPandas", "WindowInPandas", "PythonMapInArrow"}


@pytest.mark.parametrize("name", sorted(catalog()))
def test_no_pair_emitting_join_and_no_python(spark, name):
    ops = set(operators(catalog()[name](spark, SF_SMALL)))
    assert "CartesianProduct" not in ops
    assert "BroadcastNestedLoopJoin" not in ops
    assert not (ops & PYTHON_NODES)


def test_grid_report_has_no_expand(spark):
    ops = operators(catalog()["campaign_day_performance"](spark, SF_SMALL))
    assert "Expand" not in ops and "Generate" in ops


@pytest.mark.parametrize("name", ["q10_landing_page_kpis", "q11_device_kpis"])
def test_breakdown_scans_clicks_once(spark, name):
    assert scans_of(catalog()[name](spark, SF_SMALL), "/clicks") == 1


def test_range_filter_reaches_scan(spark):
    pf = " ".join(pushed_filters(catalog()["campaign_performance"](spark, SF_SMALL)))
    assert "GreaterThanOrEqual(session_datetime" in pf and "LessThan(session_datetime" in pf
    assert "GreaterThanOrEqual(click_datetime" in pf


def test_scan_reads_only_needed_columns(spark):
    text = plan_text(catalog()["q05_conversion_mix"](spark, SF_SMALL))
    assert "ReadSchema: struct<conversion_type:string,revenue:decimal(10,2)>" in text


def test_new_flag_uses_aggregate_not_user_window(spark):
    # The first-session flag is a per-user MIN (partial aggregation), not a window over users.
    ops = operators(catalog()["q06_new_vs_returning"](spark, SF_SMALL))
    assert "Window" not in ops and "SortAggregate" not in ops


def test_conditional_distinct_has_no_expand(spark):
    assert "Expand" not in operators(catalog()["agg_distinct_conditional"](spark, SF_SMALL))


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in operators(catalog()["top5_sessions"](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["c01_cohort_lift", "c02_cohort_campaign", "c03_cohort_campaign_device"])
def test_cohort_range_reaches_every_click_scan(spark, name):
    import re
    text = plan_text(catalog()[name](spark, SF_SMALL))
    blocks = [b for b in re.findall(r"\(\d+\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?ReadSchema: [^\n]*", text)
              if "/clicks]" in b]
    assert blocks
    for b in blocks:
        assert "GreaterThanOrEqual(click_datetime" in b and "LessThan(click_datetime" in b


@pytest.mark.parametrize("name", ["c01_cohort_lift", "c02_cohort_campaign", "c03_cohort_campaign_device"])
def test_cohort_range_reaches_the_conversions_scan(spark, name):
    pf = " ".join(pushed_filters(catalog()[name](spark, SF_SMALL)))
    assert "GreaterThanOrEqual(conversion_datetime" in pf and "LessThan(conversion_datetime" in pf
