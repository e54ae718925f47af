"""Invariants on the driver-data model (sf0.001)."""

from decimal import Decimal

from pyspark.sql import functions as F

from adlens.operators import insights, reports, views
from adlens.sources.model import build_model, load_model, with_day
from adlens.sources.schema import DAY_COLUMNS
from tests.conftest import SF_SMALL


def test_stored_model_equals_derivation(spark):
    stored, lazy = load_model(spark, SF_SMALL), build_model(spark, SF_SMALL)
    for name in ("campaigns", "users", "clicks", "sessions", "conversions", "costs_daily", "cost_feed"):
        a, b = stored.table(name), lazy.table(name)
        if name in ("clicks", "sessions"):      # stored with their day
            b = with_day(b, name)
        elif name in DAY_COLUMNS:               # the session's day: tests/test_layout.py
            a = a.drop(DAY_COLUMNS[name])
        # file reads mark every column nullable; compare names and types
        assert [(f.name, f.dataType) for f in a.schema] == [(f.name, f.dataType) for f in b.schema], name
        assert a.count() == b.count() and a.exceptAll(b).count() == 0, name


def test_mapping_sizes(spark):
    m = load_model(spark, SF_SMALL)
    linked = m.sessions.filter(F.col("click_id").isNotNull()).count()
    assert (m.clicks.count(), m.sessions.count(), linked, m.conversions.count()) == (201, 188, 81, 364)


def test_kpi_invariants(spark):
    m = load_model(spark, SF_SMALL)
    day = views.campaign_day_kpis(m.clicks, m.sessions, m.conversions, m.campaigns).collect()
    for r in day:
        assert r.new_user_sessions + r.returning_sessions == r.sessions
        assert r.first_conversions <= min(r.sessions, r.conversions)
    for r in insights.landing_page_kpis(m.campaigns, m.clicks, m.sessions, m.conversions).collect():
        assert r.clicks - r.sessions == r.orphan_clicks
    for r in views.click_cohort(m.clicks, m.sessions, m.conversions).collect():
        assert r.sessions_converted_D0 <= r.sessions_converted_D7 <= r.sessions_converted_D30 <= r.sessions


def test_range_report_equals_sum_of_grid(spark):
    m = load_model(spark, SF_SMALL)
    r1 = {r.campaign_id: r for r in reports.campaign_performance(
        m.campaigns, m.clicks, m.sessions, m.conversions, "2024-01-01", "2024-01-31").collect()}
    r2 = reports.campaign_day_performance(m.campaigns, m.clicks, m.sessions, m.conversions,
                                          "2024-01-01", "2024-01-31")
    sums = {r.campaign_id: r for r in r2.groupBy("campaign_id").agg(
        F.sum("sessions").alias("s"), F.sum("clicks").alias("c"), F.sum("conversions").alias("v"),
        F.sum("revenue").alias("rev"), F.sum("cost").alias("cost")).collect()}
    assert len(r1) == 25 and set(sums) == set(r1)
    for cid, r in r1.items():
        s = sums[cid]
        assert (r.sessions, r.clicks, r.conversions, r.revenue, r.cost) == (s.s, s.c, s.v, s.rev, s.cost)


def test_results_do_not_depend_on_input_partitioning(spark):
    m = load_model(spark, SF_SMALL)
    a = views.campaign_day_kpis(m.clicks, m.sessions, m.conversions, m.campaigns)
    b = views.campaign_day_kpis(m.clicks.repartition(7), m.sessions.repartition(3, "user_id"),
                                m.conversions.repartition(5), m.campaigns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    e1 = views.sessions_enriched(m.sessions)
    e2 = views.sessions_enriched(m.sessions.repartition(9))
    assert e1.exceptAll(e2).count() == 0


def test_idle_campaign_present(spark):
    m = load_model(spark, SF_SMALL)
    r1 = {r.campaign_id: r for r in reports.campaign_performance(
        m.campaigns, m.clicks, m.sessions, m.conversions, "2024-01-08", "2024-01-21").collect()}
    assert r1[24].sessions == 0 and r1[24].CPS == Decimal("0.00")
