"""Stored layout: range reports prune all three facts to their days; joins on bucketed keys move no fact rows."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from adlens.operators import facts, reports
from adlens.plans.catalog import REPORT_RANGE, catalog
from adlens.plans.inspect import plan_text
from adlens.sources import model as M
from adlens.sources.model import build_model, conversions_by_day, load_model
from tests.conftest import SF_SMALL


def scans(df):
    """table -> scan block of the formatted plan (campaigns and other whole tables included)."""
    out = {}
    for block in re.findall(r"\(\d+\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?ReadSchema: [^\n]*", plan_text(df)):
        name = re.search(r"/(campaigns|clicks|sessions|conversions)[\],/]", block) or re.search(r"adlens_(clicks|sessions)_", block)
        out.setdefault(name[1], []).append(block)
    return out


@pytest.mark.parametrize("name", ["campaign_performance", "campaign_day_performance"])
def test_range_reports_prune_every_fact_by_day(spark, name):
    found = scans(catalog()[name](spark, SF_SMALL))
    for table, day in (("clicks", "click_day"), ("sessions", "session_day"), ("conversions", "session_day")):
        assert found[table]
        for block in found[table]:
            pruned = re.search(r"PartitionFilters: \[([^\n]*)\]", block)
            assert pruned and f">= {REPORT_RANGE[0]}" in pruned[1] and f"<= {REPORT_RANGE[1]}" in pruned[1] and day in pruned[1]


def test_pruned_reports_equal_unpruned_ones(spark):
    stored, plain = load_model(spark, SF_SMALL), build_model(spark, SF_SMALL)
    for report in (reports.campaign_performance, reports.campaign_day_performance):
        a, b = (sorted(report(m.campaigns, m.clicks, m.sessions, m.conversions, *REPORT_RANGE).collect()) for m in (stored, plain))
        assert a == b


def test_conversions_lie_under_their_sessions_day(spark):
    m = load_model(spark, SF_SMALL)
    own = conversions_by_day(m.conversions.drop("session_day"), m.sessions)
    assert own.select("conversion_id", "session_day").exceptAll(m.conversions.select("conversion_id", "session_day")).count() == 0
    late = m.conversions.filter(F.col("conversion_datetime").cast("date") > F.col("session_day")).count()
    assert late > 0                     # a conversion after the session's day is found there nevertheless


def _without_broadcast(spark, build):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return build()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _moved(plan, column):
    """Exchanges whose rows carry ``column``: the list of columns stands in the line below."""
    lines = plan.split("\n")
    return sum("Exchange hashpartitioning" in line and column in lines[k + 1] for k, line in enumerate(lines[:-1]))


def test_session_join_moves_no_session(spark):
    m = load_model(spark, SF_SMALL)
    plan = _without_broadcast(spark, lambda: facts.session_facts(m.sessions, m.conversions))
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan
    assert _moved(plan, "landing_page") == 0
    # conversions move as sums by session
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan.split("Exchange hashpartitioning")[1]


def test_click_join_moves_no_click(spark):
    m = load_model(spark, SF_SMALL)
    plan = _without_broadcast(spark, lambda: m.clicks.join(m.sessions.filter("click_id IS NOT NULL").select("click_id", "session_id"), "click_id"))
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1     # the sessions' keys


def test_bucketed_tables_are_found_by_a_new_session(spark):
    m = load_model(spark, SF_SMALL)
    want = m.sessions.count(), m.clicks.count()
    for name in ("sessions", "clicks"):
        spark.sql(f"DROP TABLE {M._table_name(m.location, name)}")     # external: the files stay
    M._CACHE.clear()
    again = load_model(spark, SF_SMALL)
    assert again.reused and (again.sessions.count(), again.clicks.count()) == want
    assert again.sessions.filter(F.col("session_day") == dt.date(2024, 1, 9)).count() == \
        again.sessions.filter(F.col("session_datetime").cast("date") == dt.date(2024, 1, 9)).count()


def test_layout_without_buckets(spark):
    m = load_model(spark, SF_SMALL, buckets=0)
    assert m.sessions.count() == load_model(spark, SF_SMALL).sessions.count()


def test_files_grow_with_the_input_not_with_shuffle_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        m = load_model(spark, SF_SMALL)
        days = m.sessions.select("session_day").distinct().count()
        assert len(m.sessions.inputFiles()) <= M.LEAST_BUCKETS * days
        assert len(m.clicks.inputFiles()) <= M.LEAST_BUCKETS * days
        spark.conf.set("spark.sql.shuffle.partitions", "600")
        assert M.bucket_count(spark, 0) == M.LEAST_BUCKETS
        assert M.bucket_count(spark, 100 * M.BUCKET_BYTES) == 100
        assert M.bucket_count(spark, 10_000 * M.BUCKET_BYTES) == 600       # a bucket for each shuffle partition
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
