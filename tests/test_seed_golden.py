"""Golden values on the warehouse seed (tallied by hand from the seed rows)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adlens.functions.dates import ReportArgumentError
from adlens.operators import audits, insights, reports, upsert, views

D = dt.date.fromisoformat


def by(rows, key):
    return {r[key]: r for r in rows}


def test_q1_traffic(seed):
    got = {r.campaign_name: r.sessions for r in insights.traffic_by_campaign(seed.campaigns, seed.sessions).collect()}
    assert got == {"Google Search – Brand": 16, "Facebook Leads": 13, "Organic Search": 10}


def test_q1_is_sorted(seed):
    rows = insights.traffic_by_campaign(seed.campaigns, seed.sessions).collect()
    assert [r.sessions for r in rows] == [16, 13, 10]


def test_q2_conversions_revenue(seed):
    got = by(insights.conversions_revenue_by_campaign(seed.campaigns, seed.sessions, seed.conversions).collect(),
             "campaign_name")
    assert (got["Google Search – Brand"].sessions, got["Google Search – Brand"].conversions,
            got["Google Search – Brand"].revenue) == (16, 10, Decimal("1020.00"))
    assert (got["Facebook Leads"].sessions, got["Facebook Leads"].conversions) == (13, 4)
    assert got["Facebook Leads"].revenue == Decimal("0.00")
    assert (got["Organic Search"].sessions, got["Organic Search"].conversions) == (10, 0)


def test_q3_snapshot_tie_rounds_up(seed):
    got = by(insights.kpi_snapshot(seed.campaigns, seed.clicks, seed.sessions, seed.conversions).collect(),
             "campaign_name")
    assert got["Google Search – Brand"].CPS == Decimal("0.63")   # 10/16 = 0.625
    assert got["Google Search – Brand"].CVR == Decimal("0.63")
    assert got["Facebook Leads"].CPS == Decimal("0.31")
    assert got["Organic Search"].CPS == Decimal("0.00")
    for r in got.values():
        assert r.ROAS == Decimal("0.00") and r.clicks == 0 and r.cost == Decimal("0.00")


def test_q5_conversion_mix(seed):
    got = {r.conversion_type: (r.conversions, r.revenue) for r in insights.conversion_mix(seed.conversions).collect()}
    assert got == {"Lead": (5, Decimal("0.00")), "Purchase": (5, Decimal("1020.00")),
                   "Registration": (4, Decimal("0.00"))}


def test_q6_new_vs_returning_in_range(seed):
    rows = insights.new_vs_returning(seed.sessions, "2024-02-15", "2024-02-28").collect()
    got = {r.session_date.isoformat(): (r.new_user_sessions, r.returning_sessions) for r in rows}
    assert got == {"2024-02-15": (1, 2), "2024-02-16": (1, 2), "2024-02-17": (1, 2),
                   "2024-02-18": (0, 3), "2024-02-19": (0, 3), "2024-02-20": (0, 3),
                   "2024-02-21": (0, 3), "2024-02-22": (0, 3)}
    assert rows[0].pct_new_sessions == Decimal("0.33")
    assert rows[-1].pct_new_sessions == Decimal("0.00")


def test_q6_new_decided_before_filter(seed):
    rows = insights.new_vs_returning(seed.sessions, "2024-02-10", "2024-02-28").collect()
    got = {r.session_date.isoformat(): (r.new_user_sessions, r.returning_sessions) for r in rows}
    assert got["2024-02-10"] == (2, 1) and got["2024-02-12"] == (1, 2) and got["2024-02-14"] == (2, 1)
    assert sum(r.new_user_sessions for r in rows) == 12


def test_sessions_by_device_and_page(seed):
    dev = {r.device: r["count"] for r in seed.sessions.groupBy("device").count().collect()}
    assert dev == {"Mobile": 20, "Desktop": 19}
    lp = {r.landing_page: r["count"] for r in seed.sessions.groupBy("landing_page").count().collect()}
    assert lp == {"/home": 7, "/blog": 7, "/contact": 7, "/services": 6, "/landing": 5, "/pricing": 4, "/about": 3}


def test_r2_grid_and_session_day_attribution(seed):
    rows = reports.campaign_day_performance(seed.campaigns, seed.clicks, seed.sessions, seed.conversions,
                                            "2024-02-10", "2024-02-22").collect()
    assert len(rows) == 39
    g = {(r.campaign_id, r.date.isoformat()): r for r in rows}
    r = g[(1, "2024-02-19")]
    assert (r.sessions, r.conversions, r.revenue, r.CPS, r.CVR) == (
        2, 1, Decimal("120.00"), Decimal("0.50"), Decimal("0.50"))
    z = g[(1, "2024-02-18")]
    assert (z.sessions, z.conversions, z.revenue, z.CPS, z.CVR, z.ROAS) == (
        0, 0, Decimal("0.00"), Decimal("0.00"), Decimal("0.00"), Decimal("0.00"))
    assert [(r.campaign_id, r.date) for r in rows] == sorted((r.campaign_id, r.date) for r in rows)


def test_r1_returns_all_campaigns_and_validates(seed):
    rows = reports.campaign_performance(seed.campaigns, seed.clicks, seed.sessions, seed.conversions,
                                        "2024-02-01", "2024-03-31").collect()
    assert len(rows) == 3
    assert rows[0].campaign_id == 1 and rows[0].revenue == Decimal("1020.00")
    with pytest.raises(ReportArgumentError) as e:
        reports.campaign_performance(seed.campaigns, seed.clicks, seed.sessions, seed.conversions, None, "2024-01-01")
    assert e.value.code == 50010
    with pytest.raises(ReportArgumentError) as e:
        reports.campaign_performance(seed.campaigns, seed.clicks, seed.sessions, seed.conversions,
                                     "2024-02-02", "2024-02-01")
    assert e.value.code == 50011
    with pytest.raises(ReportArgumentError) as e:
        reports.campaign_day_performance(seed.campaigns, seed.clicks, seed.sessions, seed.conversions,
                                         "2024-02-02", "2024-02-01")
    assert e.value.code == 50021


def _feed(spark, rows):
    from adlens.sources.schema import COST_FEED
    return spark.createDataFrame(rows, COST_FEED)


def test_upsert_update_and_insert(spark, seed):
    res = upsert.upsert_costs_daily(seed.costs_daily, _feed(spark, [(D("2024-02-10"), 1, Decimal("125.00"))]),
                                    seed.campaigns)
    audit = res.audit.collect()
    assert len(audit) == 1
    a = audit[0]
    assert (a.action_taken, a.old_cost, a.new_cost) == ("UPDATE", Decimal("120.00"), Decimal("125.00"))
    assert res.table.count() == 25
    res2 = upsert.upsert_costs_daily(seed.costs_daily, _feed(spark, [(D("2024-02-22"), 2, Decimal("70.00"))]),
                                     seed.campaigns)
    a = res2.audit.first()
    assert (a.action_taken, a.old_cost, a.old_cost_date, a.new_cost) == ("INSERT", None, None, Decimal("70.00"))
    assert res2.table.count() == 26
    total = res2.table.agg(F.sum("cost")).first()[0]
    assert total == Decimal("2845.00")  # 2775.00 + 70.00


def test_audits_clean_on_seed(seed):
    t = {n: seed.table(n) for n in ("campaigns", "users", "clicks", "sessions", "conversions", "costs_daily")}
    for fam in (audits.audit_pk, audits.audit_fk, audits.audit_check, audits.audit_not_null):
        assert sum(r.violations for r in fam(t).collect()) == 0, fam.__name__


def test_dirty_rows_pass_every_constraint(seed):
    s, c, u = seed.sessions, seed.conversions, seed.users
    early = c.join(s, "session_id").filter(F.col("conversion_datetime") < F.col("session_datetime"))
    assert [r.session_id for r in early.collect()] == [28]
    pre = s.join(u, "user_id").filter(F.col("session_datetime").cast("date") < F.col("first_seen_date"))
    assert sorted(r.session_id for r in pre.collect()) == [3, 5, 6, 8, 10, 11, 14, 15, 16, 21, 22, 24, 27, 30]


def test_sessions_enriched_sequence(seed):
    rows = views.sessions_enriched(seed.sessions).filter("user_id = 1").orderBy("rn_user_session").collect()
    assert [r.session_id for r in rows] == [1, 2, 9, 13, 23, 31]
    assert [r.is_new_user_session for r in rows] == [1, 0, 0, 0, 0, 0]


def test_r1_demo_range_values(seed):
    rows = {r.campaign_id: r for r in reports.campaign_performance(
        seed.campaigns, seed.clicks, seed.sessions, seed.conversions, "2024-02-01", "2024-03-31").collect()}
    a, b, c = rows[1], rows[2], rows[3]
    assert (a.sessions, a.conversions, a.first_conversions, a.clicks, a.revenue, a.cost) == (
        16, 10, 10, 0, Decimal("1020.00"), Decimal("0.00"))
    assert (a.CPS, a.CVR, a.ROAS) == (Decimal("0.63"), Decimal("0.63"), Decimal("0.00"))
    assert (b.sessions, b.conversions, b.CPS, b.CVR) == (13, 4, Decimal("0.31"), Decimal("0.31"))
    assert (c.sessions, c.conversions, c.CPS) == (10, 0, Decimal("0.00"))
    assert [r.campaign_id for r in reports.campaign_performance(
        seed.campaigns, seed.clicks, seed.sessions, seed.conversions, "2024-02-01", "2024-03-31").collect()] == [1, 2, 3]


def test_click_driven_relations_are_empty_without_clicks(seed):
    day = views.campaign_day_kpis(seed.clicks, seed.sessions, seed.conversions, seed.campaigns)
    assert day.count() == 0
    assert insights.campaign_totals(day).count() == 0
    assert views.click_cohort(seed.clicks, seed.sessions, seed.conversions).count() == 0
    # ...while the session-driven grid still reports every session
    grid = reports.campaign_day_performance(seed.campaigns, seed.clicks, seed.sessions, seed.conversions,
                                            "2024-02-01", "2024-03-31")
    assert grid.agg(F.sum("sessions")).first()[0] == 39
