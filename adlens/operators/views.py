"""Derived relations (the warehouse's views) as DataFrame functions.

* :func:`sessions_enriched`      - sessions + session_date + per-user sequence
* :func:`campaign_day_kpis`      - click-driven campaign x day KPIs
* :func:`click_cohort`           - campaign x click-day cohorts, D0/D7/D30
* :func:`click_cohort_device`    - the same split by session device

Cohort relations: the warehouse names them and their columns but their SQL is
not part of it. Choices made here (ASSUMED, kept deliberately):
(a) a conversion counts for window Dn when ``0 <= conversion_day - cohort_day
<= n`` - a conversion dated before the click day does not count;
(b) ``sessions`` is the number of sessions linked to the cohort's clicks, so a
cohort made only of orphan clicks exists with 0 sessions and NULL rates;
(c) the campaign is the click's campaign; (d) rates are rounded DECIMALs as in
the cohort rollups; (e) a zero denominator gives NULL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.functions.dates import as_date, date_bounds, day_of, in_range, on_days
from adlens.functions.labels import one_spelling
from adlens.functions.ratios import cohort_ratio, ratio, zero_if_null
from adlens.operators.facts import daily_clicks, money_total, session_facts
from adlens.operators.sequence import sequence_number

COHORT_WINDOWS = (0, 7, 30)


def sessions_enriched(sessions: DataFrame) -> DataFrame:
    """Every session with ``session_date``, ``rn_user_session`` (1-based
    position in the user's whole history by time, ties broken by session_id)
    and ``is_new_user_session`` (1 for the first).

    The sequence uses the hot-key-safe :func:`sequence_number`.
    """
    base = sessions.select("user_id", "session_id", "campaign_id", "landing_page", "device",
                           "session_datetime")
    seq = sequence_number(base, "user_id", ["session_datetime", "session_id"], "rn_user_session")
    return seq.select(
        "user_id", "session_id", "campaign_id", "landing_page", "device", "session_datetime",
        day_of("session_datetime").alias("session_date"),
        F.col("rn_user_session"),
        (F.col("rn_user_session") == 1).cast("int").alias("is_new_user_session"),
    )


def session_day_activity(sessions: DataFrame, conversions: DataFrame) -> DataFrame:
    """(campaign_id, activity_date = session day) -> sessions, new/returning,
    conversions, first_conversions (converted sessions), revenue - one pass."""
    facts = session_facts(sessions, conversions, new_flag=True)
    return facts.groupBy("campaign_id", F.col("session_date").alias("activity_date")).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("is_new_user_session").alias("new_user_sessions"),
        (F.count(F.lit(1)) - F.sum("is_new_user_session")).alias("returning_sessions"),
        F.sum("conversions").alias("conversions"),
        F.sum("converted").alias("first_conversions"),
        money_total("revenue").alias("revenue"),
    )


def campaign_day_kpis(clicks: DataFrame, sessions: DataFrame, conversions: DataFrame,
                      campaigns: DataFrame) -> DataFrame:
    """Click-driven daily KPIs: one row per (campaign, day) that has clicks.

    Sessions and conversions are attributed to the session's own campaign and
    day; campaign-days with sessions but no clicks are not in the result.
    Ratios are NULL on a zero denominator.
    """
    clk = daily_clicks(clicks)
    act = session_day_activity(sessions, conversions)
    dim = campaigns.select("campaign_id", "campaign_name", "channel")
    # Both aggregates come out hash-partitioned on (campaign_id, activity_date):
    # join them first (no exchange), then meet the dimension.
    j = clk.join(act, ["campaign_id", "activity_date"], "left").join(dim, "campaign_id", "inner")
    z = lambda c: zero_if_null(c)
    return j.select(
        "campaign_id", "campaign_name", "channel", "activity_date",
        z("sessions").alias("sessions"),
        z("new_user_sessions").alias("new_user_sessions"),
        z("returning_sessions").alias("returning_sessions"),
        z("clicks").alias("clicks"),
        z("conversions").alias("conversions"),
        z("first_conversions").alias("first_conversions"),
        z("revenue").alias("revenue"),
        z("cost").alias("cost"),
        ratio(z("conversions"), z("sessions")).alias("CPS"),
        ratio(z("first_conversions"), z("sessions")).alias("CVR"),
        ratio(z("revenue"), z("cost")).alias("ROAS"),
    )


def cohort_sessions(clicks: DataFrame, sessions: DataFrame, conversions: DataFrame,
                    cohort_start=None, cohort_end=None) -> DataFrame:
    """One row per click-linked session: campaign_id (the click's),
    cohort_date (the click's day), device, session_id and 0/1 flags
    ``converted_D0/D7/D30``."""
    linked = sessions.filter(F.col("click_id").isNotNull()).select("session_id", "click_id", "device")
    clk = clicks.select("click_id", "campaign_id", day_of("click_datetime").alias("cohort_date"))
    sess = linked.join(clk, "click_id", "inner")
    # Only the conversion *days* of a session matter: its set of days is built
    # map-side and bounded by the calendar, however many conversions it has. One
    # exchange on session_id serves the aggregate and the join.
    conv = conversions.select("session_id", day_of("conversion_datetime").alias("conversion_date"))
    if cohort_start is not None:  # no other day can count for these cohorts
        conv = conv.filter(in_range("conversion_date", as_date(cohort_start),
                                    as_date(cohort_end) + dt.timedelta(days=max(COHORT_WINDOWS))))
    days = conv.groupBy("session_id").agg(F.collect_set("conversion_date").alias("_days"))

    def converted(n: int):
        within = F.exists("_days", lambda d: F.datediff(d, F.col("cohort_date")).between(0, n))
        return F.coalesce(within, F.lit(False)).cast("int").alias(f"converted_D{n}")

    return sess.join(days, "session_id", "left").select(
        "session_id", "campaign_id", "cohort_date", "device", *[converted(n) for n in COHORT_WINDOWS])


def _cohort_measures(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("session_id").alias("sessions"),
        *[F.sum(f"converted_D{n}").alias(f"sessions_converted_D{n}") for n in COHORT_WINDOWS],
    )


def _with_rates(df: DataFrame) -> DataFrame:
    return df.select("*", *[cohort_ratio(f"sessions_converted_D{n}", "sessions").alias(f"CVR_D{n}")
                            for n in COHORT_WINDOWS])


def _clicks_in(clicks: DataFrame, cohort_start, cohort_end) -> DataFrame:
    """Clicks of the cohort days ``[cohort_start, cohort_end]`` (all when no
    range). A cohort row depends only on its own day's clicks, so filtering
    here gives the same rows as filtering the finished relation - but the
    filter then reaches both click scans; Catalyst cannot carry a filter on
    the cohort day into the session side of the cohort join by itself."""
    if cohort_start is None and cohort_end is None:
        return clicks
    start, end = date_bounds(cohort_start, cohort_end, 50010)
    return on_days(clicks, "click_day", start, end).filter(in_range(day_of("click_datetime"), start, end))


def click_cohort(clicks: DataFrame, sessions: DataFrame, conversions: DataFrame,
                 cohort_start=None, cohort_end=None) -> DataFrame:
    """campaign_id x cohort_date (click day) for every day with clicks:
    sessions, sessions_converted_D0/D7/D30, CVR_D0/D7/D30; optionally only
    the cohort days in ``[cohort_start, cohort_end]``."""
    clicks = _clicks_in(clicks, cohort_start, cohort_end)
    per_session = cohort_sessions(clicks, sessions, conversions, cohort_start, cohort_end)
    measured = _cohort_measures(per_session, ["campaign_id", "cohort_date"])
    cohorts = clicks.select("campaign_id", day_of("click_datetime").alias("cohort_date")).distinct()
    j = cohorts.join(measured, ["campaign_id", "cohort_date"], "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    filled = j.select("campaign_id", "cohort_date", z("sessions"),
                      *[z(f"sessions_converted_D{n}") for n in COHORT_WINDOWS])
    return _with_rates(filled)


def click_cohort_device(clicks: DataFrame, sessions: DataFrame, conversions: DataFrame,
                        cohort_start=None, cohort_end=None) -> DataFrame:
    """campaign_id x cohort_date x device (spellings that differ in case or
    trailing blanks are one); sessions only (no orphan clicks)."""
    clicks = _clicks_in(clicks, cohort_start, cohort_end)
    per_session = cohort_sessions(clicks, sessions, conversions, cohort_start, cohort_end)
    measured = _cohort_measures(per_session, ["campaign_id", "cohort_date", "device"])
    measures = ["sessions", *[f"sessions_converted_D{n}" for n in COHORT_WINDOWS]]
    return _with_rates(one_spelling(measured, ["campaign_id", "cohort_date"], "device",
                                    [F.sum(c).alias(c) for c in measures]))
