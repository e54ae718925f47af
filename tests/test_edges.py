"""One hand-made fixture with a row for every attribution / null / boundary rule."""

import datetime as dt
from decimal import Decimal as Dec

import pytest

from adlens.operators import cohorts, insights, reports, upsert, views
from adlens.sources.schema import COST_FEED, ORPHAN_LABEL
from tests.conftest import make_model

T = dt.datetime.fromisoformat
D = dt.date.fromisoformat


@pytest.fixture(scope="module")
def m(spark):
    return make_model(spark, {
        "campaigns": [(1, "Alpha", "Search", None), (2, "Beta", "Social", None),
                      (3, "Idle", "Display", None), (4, "Alpha", "Video", None)],
        "users": [(u, D("2024-03-01"), None, None, None) for u in range(1, 6)],
        "clicks": [
            (101, 1, T("2024-03-01T10:00:00"), Dec("10.00")),
            (102, 1, T("2024-03-01T23:59:00"), Dec("5.00")),    # its session is after midnight
            (103, 2, T("2024-03-01T12:00:00"), Dec("4.00")),    # session belongs to campaign 1
            (104, 1, T("2024-03-01T15:00:00"), None),           # orphan, no cost
            (105, 2, T("2024-03-02T09:00:00"), Dec("0.00")),    # zero-cost day with revenue
            (106, 4, T("2024-03-03T10:00:00"), Dec("1.00")),
            (107, 2, T("2024-03-04T11:00:00"), Dec("2.00")),    # orphan-only cohort
        ],
        "sessions": [
            (1, 1, 1, 101, "Mobile", "/a", T("2024-03-01T10:01:00")),
            (2, 2, 1, 102, "Desktop", "/b", T("2024-03-02T00:05:00")),
            (3, 3, 1, 103, "Mobile", "/a", T("2024-03-01T12:01:00")),
            (4, 1, 2, 105, "Mobile", None, T("2024-03-02T09:01:00")),
            (5, 4, 2, None, "Desktop", "/c", T("2024-03-05T08:00:00")),  # direct
            (6, 4, 2, None, "Desktop", "/c", T("2024-03-05T08:00:00")),  # same second
            (7, 5, 4, 106, "Mobile", "/a", T("2024-03-03T10:00:00")),
        ],
        "conversions": [
            (1, 1, T("2024-03-01T10:05:00"), "Purchase", Dec("30.00")),   # +0 days
            (2, 1, T("2024-03-08T10:00:00"), "Lead", Dec("0.00")),        # +7
            (3, 1, T("2024-03-09T10:00:00"), "Purchase", Dec("20.00")),   # +8
            (4, 2, T("2024-03-31T10:00:00"), "Registration", Dec("0.00")),  # +30 from click day
            (5, 4, T("2024-03-02T09:30:00"), "Purchase", Dec("50.00")),
            (6, 3, T("2024-02-29T12:00:00"), "Lead", Dec("0.00")),        # -1: before the click day
            (7, 7, T("2024-04-03T10:00:00"), "Purchase", Dec("5.00")),    # +31
        ],
        "costs_daily": [(D("2024-03-01"), 1, Dec("10.00"))],
    })


def _day(m):
    return views.campaign_day_kpis(m.clicks, m.sessions, m.conversions, m.campaigns)


def test_day_view_is_click_driven(m):
    rows = {(r.campaign_id, r.activity_date.isoformat()): r for r in _day(m).collect()}
    assert set(rows) == {(1, "2024-03-01"), (2, "2024-03-01"), (2, "2024-03-02"), (4, "2024-03-03"),
                         (2, "2024-03-04")}
    r = rows[(1, "2024-03-01")]
    assert (r.clicks, r.cost, r.sessions, r.new_user_sessions, r.conversions, r.first_conversions, r.revenue) == (
        3, Dec("15.00"), 2, 2, 4, 2, Dec("50.00"))
    assert (r.CPS, r.CVR, r.ROAS) == (Dec("2.00"), Dec("1.00"), Dec("3.33"))
    empty = rows[(2, "2024-03-01")]
    assert empty.sessions == 0 and empty.CPS is None and empty.ROAS == Dec("0.00")
    zero_cost = rows[(2, "2024-03-02")]
    assert zero_cost.ROAS is None and zero_cost.returning_sessions == 1   # NULL policy


def test_range_report_zero_policy_and_late_conversions(m):
    full = {r.campaign_id: r for r in reports.campaign_performance(
        m.campaigns, m.clicks, m.sessions, m.conversions, "2024-03-01", "2024-03-31").collect()}
    assert (full[1].sessions, full[1].conversions, full[1].first_conversions, full[1].clicks) == (3, 5, 3, 3)
    assert (full[1].CPS, full[1].ROAS) == (Dec("1.67"), Dec("3.33"))
    assert (full[2].ROAS, full[2].cost) == (Dec("8.33"), Dec("6.00"))
    assert (full[3].sessions, full[3].clicks, full[3].CPS, full[3].ROAS) == (0, 0, Dec("0.00"), Dec("0.00"))
    one_day = {r.campaign_id: r for r in reports.campaign_performance(
        m.campaigns, m.clicks, m.sessions, m.conversions, "2024-03-01", "2024-03-01").collect()}
    assert (one_day[1].sessions, one_day[1].conversions) == (2, 4)   # conversions after the range count


def test_grid_zero_cost_roas_is_zero(m):
    g = {(r.campaign_id, r.date.isoformat()): r for r in reports.campaign_day_performance(
        m.campaigns, m.clicks, m.sessions, m.conversions, "2024-03-01", "2024-03-05").collect()}
    assert len(g) == 4 * 5
    assert g[(2, "2024-03-02")].ROAS == Dec("0.00")
    assert g[(2, "2024-03-05")].sessions == 2        # direct sessions are in the grid
    assert g[(1, "2024-03-02")].sessions == 1        # session after midnight: its own day


def test_click_day_attribution(m):
    q4 = {(r.activity_date.isoformat(), r.campaign_name, r.channel): r for r in
          insights.click_day_kpis(m.campaigns, m.clicks, m.sessions, m.conversions).collect()}
    a = q4[("2024-03-01", "Alpha", "Search")]
    assert (a.clicks, a.sessions, a.conversions, a.first_conversions) == (3, 2, 4, 2)
    b = q4[("2024-03-01", "Beta", "Social")]
    assert (b.clicks, b.sessions) == (1, 1)          # the click's campaign wins
    assert q4[("2024-03-02", "Beta", "Social")].ROAS == Dec("0.00")


def test_landing_page_orphan_bucket(m):
    rows = {(r.campaign_id, r.landing_page): r for r in
            insights.landing_page_kpis(m.campaigns, m.clicks, m.sessions, m.conversions).collect()}
    o1 = rows[(1, ORPHAN_LABEL)]
    assert (o1.clicks, o1.sessions, o1.orphan_clicks, o1.cost, o1.CPS) == (1, 0, 1, Dec("0.00"), None)
    o2 = rows[(2, ORPHAN_LABEL)]     # absorbs the session with no landing page
    assert (o2.clicks, o2.sessions, o2.orphan_clicks, o2.revenue, o2.cost, o2.ROAS) == (
        2, 1, 1, Dec("50.00"), Dec("2.00"), Dec("25.00"))
    a = rows[(1, "/a")]
    assert (a.conversions, a.first_conversions, a.CPS, a.ROAS) == (3, 1, Dec("3.00"), Dec("5.00"))
    for r in rows.values():
        assert r.clicks - r.sessions == r.orphan_clicks


def test_device_orphan_bucket_is_pure(m):
    rows = {(r.campaign_id, r.device): r for r in
            insights.device_kpis(m.campaigns, m.clicks, m.sessions, m.conversions).collect()}
    assert rows[(2, "Mobile")].sessions == 2
    assert rows[(2, ORPHAN_LABEL)].sessions == 0 and rows[(1, ORPHAN_LABEL)].sessions == 0


def test_cohort_windows_and_orphan_cohort(m):
    v3 = {(r.campaign_id, r.cohort_date.isoformat()): r for r in
          views.click_cohort(m.clicks, m.sessions, m.conversions).collect()}
    a = v3[(1, "2024-03-01")]
    assert (a.sessions, a.sessions_converted_D0, a.sessions_converted_D7, a.sessions_converted_D30) == (2, 1, 1, 2)
    assert (a.CVR_D0, a.CVR_D7, a.CVR_D30) == (Dec("0.50"), Dec("0.50"), Dec("1.00"))
    neg = v3[(2, "2024-03-01")]                  # conversion before the click day: not counted
    assert (neg.sessions, neg.sessions_converted_D30) == (1, 0)
    late = v3[(4, "2024-03-03")]                 # +31 days: outside D30
    assert late.sessions_converted_D30 == 0
    orphan = v3[(2, "2024-03-04")]
    assert orphan.sessions == 0 and orphan.CVR_D0 is None
    for r in v3.values():
        assert r.sessions_converted_D0 <= r.sessions_converted_D7 <= r.sessions_converted_D30 <= r.sessions


def test_cohort_device_has_no_orphans(m):
    v4 = views.click_cohort_device(m.clicks, m.sessions, m.conversions).collect()
    assert ORPHAN_LABEL not in {r.device for r in v4}
    assert sum(r.sessions for r in v4) == 5


def test_lift_rollup_vs_day(spark):
    c = make_model(spark, {
        "campaigns": [(1, "A", "S", None)],
        "clicks": [(i, 1, T("2024-03-10T10:00:00"), Dec("1.00")) for i in (1, 2, 3)],
        "sessions": [(i, i, 1, i, "Mobile", "/", T("2024-03-10T10:01:00")) for i in (1, 2, 3)],
        "conversions": [(1, 1, T("2024-03-10T11:00:00"), "Lead", Dec("0")),
                        (2, 2, T("2024-03-15T11:00:00"), "Lead", Dec("0"))],
    })
    v3 = views.click_cohort(c.clicks, c.sessions, c.conversions)
    day = cohorts.cohort_day_lift(v3, c.campaigns, "2024-03-01", "2024-03-31").first()
    roll = cohorts.cohort_campaign_rollup(v3, c.campaigns, "2024-03-01", "2024-03-31").first()
    assert (day.CVR_D0, day.CVR_D7, day.lift_0_to_7) == (Dec("0.33"), Dec("0.67"), Dec("0.34"))
    assert (roll.CVR_D0, roll.CVR_D7, roll.lift_0_to_7) == (Dec("0.33"), Dec("0.67"), Dec("0.33"))


def test_same_name_campaigns(m):
    q1 = {(r.campaign_name, r.channel): r.sessions for r in insights.traffic_by_campaign(m.campaigns, m.sessions).collect()}
    assert q1[("Alpha", "Search")] == 3 and q1[("Alpha", "Video")] == 1 and q1[("Idle", "Display")] == 0
    q2 = {r.campaign_name: r for r in
          insights.conversions_revenue_by_campaign(m.campaigns, m.sessions, m.conversions).collect()}
    assert (q2["Alpha"].sessions, q2["Alpha"].conversions, q2["Alpha"].revenue) == (4, 6, Dec("55.00"))


def test_same_second_sessions_tie_break(m):
    rows = {r.session_id: r for r in views.sessions_enriched(m.sessions).collect()}
    assert (rows[5].rn_user_session, rows[6].rn_user_session) == (1, 2)
    trend = {r.session_date.isoformat(): r for r in insights.new_vs_returning(m.sessions, "2024-03-01", "2024-03-31").collect()}
    assert (trend["2024-03-05"].new_user_sessions, trend["2024-03-05"].returning_sessions) == (1, 1)
    assert (trend["2024-03-02"].new_user_sessions, trend["2024-03-02"].returning_sessions) == (1, 1)


def test_top_day_tie_goes_to_earliest(spark):
    cols = "campaign_id int, campaign_name string, channel string, activity_date date, clicks long, sessions long, " \
           "conversions long, first_conversions long, revenue decimal(18,2), cost decimal(18,2), " \
           "CPS decimal(18,2), CVR decimal(18,2), ROAS decimal(18,2)"
    row = lambda d: (1, "A", "S", D(d), 1, 2, 1, 1, Dec("9.00"), Dec("1.00"), None, None, None)
    df = spark.createDataFrame([row("2024-03-05"), row("2024-03-02"), row("2024-03-09")], cols)
    assert insights.top_revenue_day(df).first().activity_date == D("2024-03-02")


def test_totals_from_view_lose_unclicked_sessions(m):
    q8 = {r.campaign_id: r for r in insights.campaign_totals(_day(m)).collect()}
    r1 = {r.campaign_id: r for r in reports.campaign_performance(
        m.campaigns, m.clicks, m.sessions, m.conversions, "2024-01-01", "2024-12-31").collect()}
    assert q8[1].total_sessions == 2 and r1[1].sessions == 3
    for cid, r in q8.items():
        assert r.total_sessions <= r1[cid].sessions


def test_rejects_first_failing_check_wins(spark, m):
    d = D("2024-03-01")
    feed = spark.createDataFrame([
        (None, 1, Dec("1.00")), (d, None, Dec("1.00")), (d, 1, None), (d, 1, Dec("-1.00")),
        (d, 999, Dec("1.00")), (None, None, Dec("-5.00")), (d, 2, Dec("3.00"))], COST_FEED)
    rej = sorted(r.error_code for r in upsert.feed_rejects(feed, m.campaigns).collect())
    assert rej == [50030, 50030, 50031, 50032, 50033, 50034]
    res = upsert.upsert_costs_daily(m.costs_daily, feed, m.campaigns)
    assert [r.action_taken for r in res.audit.collect()] == ["INSERT"]
    assert res.table.count() == 2


def test_duplicate_feed_key_refused(spark, m):
    d = D("2024-03-01")
    feed = spark.createDataFrame([(d, 1, Dec("1.00")), (d, 1, Dec("2.00")), (d, 1, Dec("2.00")), (d, 2, Dec("3.00"))], COST_FEED)
    res = upsert.upsert_costs_daily(m.costs_daily, feed, m.campaigns)
    assert sorted(map(tuple, res.conflicts.collect())) == [(d, 1, Dec("1.00"), 1), (d, 1, Dec("2.00"), 2)]
    # no row of the key is applied, its target row stays; other keys are
    before = {(r.cost_date, r.campaign_id): r.cost for r in m.costs_daily.collect()}
    assert {(r.cost_date, r.campaign_id): r.cost for r in res.table.collect()} == before | {(d, 2): Dec("3.00")}
    with pytest.raises(upsert.UpsertConflict):
        upsert.write_upsert(res, "/nowhere/at/all")


def test_upsert_twice_is_stable_and_logs_updates(spark, m):
    d = D("2024-03-02")
    feed = spark.createDataFrame([(d, 1, Dec("7.00")), (D("2024-03-01"), 1, Dec("10.00"))], COST_FEED)
    once = upsert.upsert_costs_daily(m.costs_daily, feed, m.campaigns)
    t1 = once.table.cache()
    twice = upsert.upsert_costs_daily(t1, feed, m.campaigns)
    assert sorted(twice.table.collect()) == sorted(t1.collect())
    assert {r.action_taken for r in twice.audit.collect()} == {"UPDATE"}
    # an unchanged value is still logged as an update
    assert {(r.action_taken, r.old_cost, r.new_cost) for r in once.audit.collect()
            if r.new_cost_date == D("2024-03-01")} == {("UPDATE", Dec("10.00"), Dec("10.00"))}


def test_write_upsert_never_overwrites(spark, m):
    import tempfile

    from pyspark.errors import AnalysisException
    feed = spark.createDataFrame([(D("2024-03-02"), 1, Dec("7.00"))], COST_FEED)
    res = upsert.upsert_costs_daily(m.costs_daily, feed, m.campaigns)
    where = tempfile.mkdtemp(prefix="adlens-upsert-") + "/v1"
    paths = upsert.write_upsert(res, where)
    assert spark.read.parquet(paths["costs_daily"]).count() == 2
    assert spark.read.parquet(paths["audit"]).first().action_taken == "INSERT"
    with pytest.raises(AnalysisException):
        upsert.write_upsert(res, where)


def test_label_spellings_are_one_group(spark):
    day = lambda k: T(f"2024-03-1{k}T10:00:00")
    c = make_model(spark, {
        "campaigns": [(1, "A", "S", None)],
        "clicks": [(i, 1, day(i), Dec("1.00")) for i in (1, 2, 3, 4)],
        "sessions": [(1, 1, 1, 1, "Mobile", "/a", day(1)), (2, 2, 1, 2, "MOBILE", "/A ", day(2)),
                     (3, 3, 1, 3, "mobile  ", " /a", day(3))],
        "conversions": [(1, 2, T("2024-03-12T11:00:00"), "Lead", Dec("3.00"))],
    })
    dev = {r.device: r for r in insights.device_kpis(c.campaigns, c.clicks, c.sessions, c.conversions).collect()}
    assert set(dev) == {"MOBILE", ORPHAN_LABEL}
    r = dev["MOBILE"]
    assert (r.clicks, r.sessions, r.conversions, r.revenue, r.cost, r.CVR) == (3, 3, 1, Dec("3.00"), Dec("3.00"), Dec("0.33"))
    pages = insights.landing_page_kpis(c.campaigns, c.clicks, c.sessions, c.conversions).collect()
    assert {r.landing_page: r.sessions for r in pages} == {"/A ": 2, " /a": 1, ORPHAN_LABEL: 0}   # leading blanks count
    v4 = views.click_cohort_device(c.clicks, c.sessions, c.conversions)
    assert v4.count() == 3   # one a day
    roll = cohorts.cohort_campaign_device_rollup(v4, c.campaigns, "2024-03-01", "2024-03-31").collect()
    assert [(r.device, r.total_sessions, r.conv_sessions_D7) for r in roll] == [("MOBILE", 3, 1)]


def test_reversed_range_is_empty_where_the_original_has_no_check(m):
    assert insights.new_vs_returning(m.sessions, "2024-03-31", "2024-03-01").count() == 0
    v3 = views.click_cohort(m.clicks, m.sessions, m.conversions, "2024-03-31", "2024-03-01")
    assert v3.count() == 0
    assert cohorts.cohort_campaign_rollup(v3, m.campaigns, "2024-03-31", "2024-03-01").count() == 0
