"""The analysis pack: traffic, conversion, KPI snapshot, click-day KPIs,
conversion mix, new-vs-returning trends, top day, campaign totals and the
landing-page / device breakdowns with orphan clicks.

Output grain and columns follow the warehouse's query pack exactly - including
its quirks (Q1 groups by name and channel, Q2 by name only).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlens.functions.dates import date_bounds, day_of, in_range, on_days
from adlens.functions.labels import label_key, one_spelling
from adlens.functions.ratios import ratio, ratio_or_0, zero_if_null
from adlens.operators.facts import (daily_clicks, first_sessions, money_sum, money_total,
                                    session_facts)
from adlens.sources.schema import ORPHAN_LABEL


def traffic_by_campaign(campaigns: DataFrame, sessions: DataFrame) -> DataFrame:
    """Q1 - sessions per (campaign_name, channel), idle campaigns with 0. Spellings that differ in case or
    trailing blanks are one group, as in the warehouse's collation; rows are per campaign by then."""
    per = sessions.groupBy("campaign_id").agg(F.count("session_id").alias("n"))
    j = campaigns.join(per, "campaign_id", "left")
    by = [label_key("campaign_name").alias("_name"), label_key("channel").alias("_channel")]
    return (j.groupBy(*by).agg(F.min("campaign_name").alias("campaign_name"), F.min("channel").alias("channel"),
                               zero_if_null(F.sum("n")).alias("sessions"))
             .drop("_name", "_channel").orderBy(F.desc("sessions"), "campaign_name", "channel"))


def conversions_revenue_by_campaign(campaigns: DataFrame, sessions: DataFrame,
                                    conversions: DataFrame) -> DataFrame:
    """Q2 - per campaign_name: distinct sessions, distinct conversions, revenue.

    Session and conversion ids are unique and a session has one campaign, so
    the distinct counts are sums of per-campaign counts (no COUNT DISTINCT)."""
    facts = session_facts(sessions.select("session_id", "campaign_id", "session_datetime"), conversions)
    per = facts.groupBy("campaign_id").agg(
        F.count("session_id").alias("s"), F.sum("conversions").alias("c"), money_sum("revenue").alias("r"))
    j = campaigns.join(per, "campaign_id", "left")
    return (j.groupBy(label_key("campaign_name").alias("_name")).agg(
                F.min("campaign_name").alias("campaign_name"),
                zero_if_null(F.sum("s")).alias("sessions"),
                zero_if_null(F.sum("c")).alias("conversions"),
                money_total("r").alias("revenue"))
             .drop("_name").orderBy(F.desc("revenue"), F.desc("conversions"), F.desc("sessions"), "campaign_name"))


def kpi_snapshot(campaigns: DataFrame, clicks: DataFrame, sessions: DataFrame,
                 conversions: DataFrame) -> DataFrame:
    """Q3 - all-time KPIs per campaign; 0.00 on a zero denominator."""
    facts = session_facts(sessions.select("session_id", "campaign_id", "session_datetime"), conversions)
    sc = facts.groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("conversions").alias("conversions"),
        F.sum("converted").alias("first_conversions"), money_sum("revenue").alias("revenue"))
    cl = clicks.groupBy("campaign_id").agg(F.count(F.lit(1)).alias("clicks"), money_sum("cost").alias("cost"))
    j = campaigns.join(cl, "campaign_id", "left").join(sc, "campaign_id", "left")
    z = zero_if_null
    return j.select(
        "campaign_name",
        z("clicks").alias("clicks"), z("sessions").alias("sessions"),
        z("conversions").alias("conversions"), z("first_conversions").alias("first_conversions"),
        z("revenue").alias("revenue"), z("cost").alias("cost"),
        ratio_or_0(z("conversions"), z("sessions")).alias("CPS"),
        ratio_or_0(z("first_conversions"), z("sessions")).alias("CVR"),
        ratio_or_0(z("revenue"), z("cost")).alias("ROAS"),
        "campaign_id",
    ).orderBy(F.desc("ROAS"), F.desc("revenue"), F.desc("sessions"), "campaign_id").drop("campaign_id")


def click_day_kpis(campaigns: DataFrame, clicks: DataFrame, sessions: DataFrame,
                   conversions: DataFrame) -> DataFrame:
    """Q4 - KPIs per (click day, click campaign); sessions reach a campaign-day
    through their click, direct sessions drop out; 0.00 policy."""
    cd = daily_clicks(clicks)
    linked = sessions.filter(F.col("click_id").isNotNull()).select("session_id", "click_id", "session_datetime")
    facts = session_facts(linked, conversions).join(
        clicks.select("click_id", "campaign_id", day_of("click_datetime").alias("activity_date")),
        "click_id", "inner")
    sc = facts.groupBy("campaign_id", "activity_date").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("conversions").alias("conversions"),
        F.sum("converted").alias("first_conversions"), money_sum("revenue").alias("revenue"))
    dim = campaigns.select("campaign_id", "campaign_name", "channel")
    j = cd.join(sc, ["campaign_id", "activity_date"], "left").join(dim, "campaign_id", "inner")
    z = zero_if_null
    return j.select(
        "activity_date", "campaign_name", "channel", "clicks",
        z("sessions").alias("sessions"), z("conversions").alias("conversions"),
        z("first_conversions").alias("first_conversions"), z("revenue").alias("revenue"),
        z("cost").alias("cost"),
        ratio_or_0(z("conversions"), z("sessions")).alias("CPS"),
        ratio_or_0(z("first_conversions"), z("sessions")).alias("CVR"),
        ratio_or_0(z("revenue"), z("cost")).alias("ROAS"),
    ).orderBy("activity_date", "campaign_name")


def conversion_mix(conversions: DataFrame) -> DataFrame:
    """Q5 - conversions and revenue per conversion_type."""
    per = conversions.groupBy("conversion_type").agg(F.count(F.lit(1)).alias("conversions"), money_sum("revenue").alias("revenue"))
    return (one_spelling(per, [], "conversion_type", [F.sum("conversions").alias("conversions"), money_total("revenue").alias("revenue")])
            .select("conversion_type", "conversions", "revenue").orderBy(F.desc("conversions"), F.desc("revenue"), "conversion_type"))


def new_vs_returning(sessions: DataFrame, start_date, end_date) -> DataFrame:
    """Q6 - daily new vs returning sessions in ``[start, end]``. "New" is the
    user's first session over the whole history, decided before the date
    filter (the first-session set is computed from the unfiltered table)."""
    start, end = date_bounds(start_date, end_date, 50010)
    firsts = first_sessions(sessions)
    in_range_s = on_days(sessions, "session_day", start, end).filter(in_range(day_of("session_datetime"), start, end)).select(
        "session_id", day_of("session_datetime").alias("session_date"))
    flagged = in_range_s.join(firsts, "session_id", "left").select(
        "session_date", zero_if_null("is_new_user_session").alias("is_new"))
    agg = flagged.groupBy("session_date").agg(
        F.sum("is_new").alias("new_user_sessions"),
        F.sum(1 - F.col("is_new")).alias("returning_sessions"),
        F.count(F.lit(1)).alias("total_sessions"))
    return agg.select("*", ratio("new_user_sessions", "total_sessions").alias("pct_new_sessions")) \
              .orderBy("session_date")


def top_revenue_day(day_kpis: DataFrame) -> DataFrame:
    """Q7 - each campaign's best day by revenue, conversions, sessions
    (descending); remaining ties go to the earliest day. Runs over the
    campaign x day relation, whose size is bounded by the calendar."""
    w = Window.partitionBy("campaign_id").orderBy(
        F.desc("revenue"), F.desc("conversions"), F.desc("sessions"), F.asc("activity_date"))
    ranked = day_kpis.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    return ranked.select(
        "campaign_id", "campaign_name", "channel", "activity_date", "clicks", "sessions",
        "conversions", "first_conversions", "revenue", "cost", "CPS", "CVR", "ROAS",
    ).orderBy(F.desc("revenue"), "campaign_id")


def campaign_totals(day_kpis: DataFrame) -> DataFrame:
    """Q8 - campaign totals from the daily view (ratio of sums, NULL policy)."""
    agg = day_kpis.groupBy("campaign_id", "campaign_name", "channel").agg(
        F.sum("clicks").alias("total_clicks"), F.sum("sessions").alias("total_sessions"),
        F.sum("conversions").alias("total_conversions"),
        F.sum("first_conversions").alias("total_first_conversions"),
        money_sum("revenue").alias("total_revenue"), money_sum("cost").alias("total_cost"))
    return agg.select(
        "*",
        ratio("total_conversions", "total_sessions").alias("CPS_total"),
        ratio("total_first_conversions", "total_sessions").alias("CVR_total"),
        ratio("total_revenue", "total_cost").alias("ROAS_total"),
    ).orderBy(F.desc("total_revenue"), F.desc("total_sessions"), "campaign_id")


def trend_from_day_kpis(day_kpis: DataFrame) -> DataFrame:
    """Q9 - new vs returning per day from the click-driven daily view."""
    agg = day_kpis.groupBy("activity_date").agg(
        F.sum("new_user_sessions").alias("new_user_sessions"),
        F.sum("returning_sessions").alias("returning_sessions"),
        F.sum("sessions").alias("total_sessions"))
    return agg.select("*", ratio("new_user_sessions", "total_sessions").alias("pct_new_sessions")) \
              .orderBy("activity_date")


def _click_breakdown(campaigns: DataFrame, clicks: DataFrame, sessions: DataFrame,
                     conversions: DataFrame, attr: str) -> DataFrame:
    """Clicks (all of them) left-joined to their session's facts in one pass,
    grouped by the click's campaign and the session attribute; clicks without
    a session - and, for a nullable attribute, sessions without a value - fall
    into the orphan bucket. Spellings that differ in case or trailing blanks are
    one value."""
    linked = sessions.filter(F.col("click_id").isNotNull()).select(
        "session_id", "click_id", attr, "session_datetime")
    facts = session_facts(linked, conversions)
    base = clicks.select("click_id", "campaign_id", "cost").join(
        facts.select("click_id", "session_id", attr, "conversions", "converted", "revenue"),
        "click_id", "left")
    agg = base.groupBy("campaign_id", F.coalesce(F.col(attr), F.lit(ORPHAN_LABEL)).alias(attr)).agg(
        F.count("click_id").alias("clicks"),
        F.count("session_id").alias("sessions"),
        zero_if_null(F.sum("conversions")).alias("conversions"),
        zero_if_null(F.sum("converted")).alias("first_conversions"),
        money_total("revenue").alias("revenue"),
        money_total(F.coalesce(F.col("cost"), F.lit(0).cast("decimal(10,2)"))).alias("cost"),
    )
    counts = ["clicks", "sessions", "conversions", "first_conversions"]
    agg = one_spelling(agg, ["campaign_id"], attr, [*[F.sum(c).alias(c) for c in counts],
                                                    money_total("revenue").alias("revenue"),
                                                    money_total("cost").alias("cost")])
    j = agg.join(campaigns.select("campaign_id", "campaign_name"), "campaign_id", "inner")
    return j.select(
        "campaign_id", "campaign_name", attr, "clicks", "sessions",
        (F.col("clicks") - F.col("sessions")).alias("orphan_clicks"),
        "conversions", "first_conversions", "revenue", "cost",
        ratio("conversions", "sessions").alias("CPS"),
        ratio("first_conversions", "sessions").alias("CVR"),
        ratio("revenue", "cost").alias("ROAS"),
    ).orderBy("campaign_id", attr)


def landing_page_kpis(campaigns, clicks, sessions, conversions) -> DataFrame:
    """Q10 - KPIs per (click campaign, landing page) with the orphan bucket."""
    return _click_breakdown(campaigns, clicks, sessions, conversions, "landing_page")


def device_kpis(campaigns, clicks, sessions, conversions) -> DataFrame:
    """Q11 - KPIs per (click campaign, device) with the orphan bucket."""
    return _click_breakdown(campaigns, clicks, sessions, conversions, "device")
