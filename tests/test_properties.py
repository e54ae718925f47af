"""Property checks: exact half-up rounding on random inputs; typed loading."""

import datetime as dt
import tempfile
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adlens.functions.ratios import cohort_lift, cohort_ratio, ratio
from adlens.sources.loaders import append_table, load_rows, read_table


def half_up(n, d):
    return (Decimal(n) / Decimal(d)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**6)), min_size=50, max_size=400))
def test_count_ratio_is_exact_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = df.select("n", "d", ratio("n", "d").alias("r"), cohort_ratio("n", "d").alias("c")).collect()
    for r in got:
        assert r.r == half_up(r.n, r.d) and r.c == half_up(r.n, r.d)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**8), st.integers(1, 10**8)), min_size=50, max_size=400))
def test_money_ratio_is_exact_half_up(spark, pairs):
    df = spark.createDataFrame([(Decimal(n) / 100, Decimal(d) / 100) for n, d in pairs],
                               "n decimal(18,2), d decimal(18,2)")
    for r in df.select("n", "d", ratio("n", "d").alias("r")).collect():
        assert r.r == half_up(r.n, r.d)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1000), st.integers(0, 1000), st.integers(1, 5000)), min_size=20, max_size=200))
def test_rollup_lift_rounds_the_exact_difference(spark, triples):
    rows = [(min(a, b), max(a, b), max(a, b, c)) for a, b, c in triples]
    df = spark.createDataFrame(rows, "lo long, hi long, n long")
    for r in df.select("lo", "hi", "n", cohort_lift("hi", "lo", "n").alias("l")).collect():
        assert r.l == half_up(r.hi - r.lo, r.n)


def test_load_rows_defaults_and_append(spark):
    t = dt.datetime(2024, 3, 1, 10, 0)
    df = load_rows(spark, [(1, 7, 2, None, "/a", t)], "sessions",
                   ["session_id", "user_id", "campaign_id", "click_id", "landing_page", "session_datetime"])
    row = df.first()
    assert row.device == "Unknown" and df.columns[4] == "device"
    conv = load_rows(spark, [(1, 1, t, "Lead")], "conversions",
                     ["conversion_id", "session_id", "conversion_datetime", "conversion_type"])
    assert conv.first().revenue == Decimal("0.00")
    where = tempfile.mkdtemp(prefix="adlens-load-") + "/sessions"
    append_table(df, "sessions", where)
    append_table(df.withColumn("session_id", F.lit(2).cast("long")), "sessions", where)
    assert read_table(spark, where, "sessions").count() == 2


def _expected_upsert(target, feed, known):
    table = dict(target)
    actions, rejects = [], []
    for d, c, v in feed:
        code = (50030 if d is None else 50031 if c is None else 50032 if v is None else
                50033 if v < 0 else 50034 if c not in known else None)
        if code:
            rejects.append(code)
            continue
        actions.append("UPDATE" if (d, c) in table else "INSERT")
        table[(d, c)] = v
    return table, sorted(actions), sorted(rejects)


_day = st.sampled_from([dt.date(2024, 3, i) for i in range(1, 6)])
_money = st.integers(-300, 5000).map(lambda c: Decimal(c) / 100)


@settings(max_examples=4, deadline=None)
@given(st.dictionaries(st.tuples(_day, st.integers(1, 3)), st.integers(0, 5000).map(lambda c: Decimal(c) / 100),
                       max_size=10),
       st.dictionaries(st.tuples(st.one_of(st.none(), _day), st.one_of(st.none(), st.integers(1, 4))),
                       st.one_of(st.none(), _money), max_size=12))
def test_upsert_matches_row_semantics(spark, target, feed_map):
    from adlens.operators.upsert import upsert_costs_daily
    from adlens.sources.schema import COST_FEED, COSTS_DAILY
    feed = [(d, c, v) for (d, c), v in feed_map.items()]
    campaigns = spark.createDataFrame([(i, f"c{i}", "s", None) for i in (1, 2, 3)],
                                      "campaign_id int, campaign_name string, channel string, start_date date")
    res = upsert_costs_daily(spark.createDataFrame([(d, c, v) for (d, c), v in target.items()], COSTS_DAILY),
                             spark.createDataFrame(feed, COST_FEED), campaigns)
    table, actions, rejects = _expected_upsert(target, feed, {1, 2, 3})
    assert {(r.cost_date, r.campaign_id): r.cost for r in res.table.collect()} == table
    assert sorted(r.action_taken for r in res.audit.collect()) == actions
    assert sorted(r.error_code for r in res.rejects.collect()) == rejects


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 9), st.booleans()), min_size=1, max_size=25),
       st.lists(st.tuples(st.integers(0, 24), st.integers(-3, 40)), max_size=40))
def test_click_cohort_matches_brute_force(spark, click_specs, conv_specs):
    from adlens.operators.views import click_cohort
    from tests.conftest import make_model
    base = dt.datetime(2024, 3, 1, 12, 0)
    clicks, sessions = [], []
    for i, (camp, day, has_session) in enumerate(click_specs):
        clicks.append((i, camp, base + dt.timedelta(days=day), Decimal("1.00")))
        if has_session:
            sessions.append((1000 + i, 1, 1, i, "Mobile", "/", base + dt.timedelta(days=day, minutes=5)))
    session_ids = [s[0] for s in sessions]
    conversions = []
    if session_ids:
        for j, (pick, lag) in enumerate(conv_specs):
            sid = session_ids[pick % len(session_ids)]
            click_day = clicks[sid - 1000][2]
            conversions.append((j, sid, click_day + dt.timedelta(days=lag), "Lead", Decimal("0")))
    m = make_model(spark, {"campaigns": [(c, f"c{c}", "s", None) for c in (1, 2, 3)],
                           "clicks": clicks, "sessions": sessions, "conversions": conversions})
    got = {(r.campaign_id, r.cohort_date): (r.sessions, r.sessions_converted_D0, r.sessions_converted_D7,
                                            r.sessions_converted_D30)
           for r in click_cohort(m.clicks, m.sessions, m.conversions).collect()}
    want = {}
    for cid, camp, ts, _ in clicks:
        key = (camp, ts.date())
        n, d0, d7, d30 = want.get(key, (0, 0, 0, 0))
        sess = [s for s in sessions if s[3] == cid]
        if sess:
            lags = [(cv[2].date() - ts.date()).days for cv in conversions if cv[1] == sess[0][0]]
            n += 1
            d0 += any(0 <= x <= 0 for x in lags)
            d7 += any(0 <= x <= 7 for x in lags)
            d30 += any(0 <= x <= 30 for x in lags)
        want[key] = (n, d0, d7, d30)
    assert got == want
