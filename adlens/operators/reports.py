"""Parameterised range reports (the warehouse's reporting procedures).

Both reports attribute sessions, conversions and revenue to the session's own
campaign and day, clicks and cost to the click's campaign and day, and use
the 0.00 policy for a zero denominator.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.functions.dates import check_range, day_of, in_range, on_days
from adlens.functions.ratios import ratio_or_0, zero_if_null
from adlens.operators.facts import money_sum, session_facts

# Error numbers of the argument checks (fixed values of the warehouse).
PERFORMANCE_MISSING, PERFORMANCE_ORDER = 50010, 50011
DAY_PERFORMANCE_MISSING, DAY_PERFORMANCE_ORDER = 50020, 50021


def _in_range(clicks: DataFrame, sessions: DataFrame, conversions: DataFrame, start: dt.date,
              end: dt.date) -> tuple[DataFrame, DataFrame]:
    """(clicks, session facts) of the range. Stored tables are pruned to the
    partitions of its days, conversions by their session's day: whenever they
    happened, they count on that day and on no other."""
    own = on_days(sessions, "session_day", start, end).filter(in_range(day_of("session_datetime"), start, end))
    clk = on_days(clicks, "click_day", start, end).filter(in_range(day_of("click_datetime"), start, end))
    return clk, session_facts(own, on_days(conversions, "session_day", start, end))


def _session_measures(facts: DataFrame, keys) -> DataFrame:
    return facts.groupBy(*keys).agg(
        F.count("session_id").alias("sessions"),
        F.sum("conversions").alias("conversions"),
        F.sum("converted").alias("first_conversions"),
        money_sum("revenue").alias("revenue"),
    )


def _click_measures(clicks: DataFrame, keys) -> DataFrame:
    return clicks.groupBy(*keys).agg(
        F.count("click_id").alias("clicks"),
        money_sum("cost").alias("cost"),
    )


def _kpis(df: DataFrame, keys: list[str]) -> DataFrame:
    z = zero_if_null
    return df.select(
        *keys,
        z("sessions").alias("sessions"),
        z("conversions").alias("conversions"),
        z("first_conversions").alias("first_conversions"),
        z("clicks").alias("clicks"),
        z("revenue").alias("revenue"),
        z("cost").alias("cost"),
        ratio_or_0(z("conversions"), z("sessions")).alias("CPS"),
        ratio_or_0(z("first_conversions"), z("sessions")).alias("CVR"),
        ratio_or_0(z("revenue"), z("cost")).alias("ROAS"),
    )


def campaign_performance(campaigns: DataFrame, clicks: DataFrame, sessions: DataFrame,
                         conversions: DataFrame, start_date, end_date, sort: bool = True) -> DataFrame:
    """KPIs per campaign for ``[start_date, end_date]`` (inclusive); every
    campaign is returned, idle ones with zeros. A session's conversions count
    even when they happen after ``end_date``.

    Columns: campaign_id, campaign_name, channel, sessions, conversions,
    first_conversions, clicks, revenue, cost, CPS, CVR, ROAS; sorted by revenue
    then sessions (descending), campaign_id.
    """
    start, end = check_range(start_date, end_date, PERFORMANCE_MISSING, PERFORMANCE_ORDER)
    in_clicks, facts = _in_range(clicks, sessions, conversions, start, end)
    sc = _session_measures(facts, ["campaign_id"])
    cl = _click_measures(in_clicks, ["campaign_id"])
    dim = campaigns.select("campaign_id", "campaign_name", "channel")
    out = _kpis(dim.join(cl, "campaign_id", "left").join(sc, "campaign_id", "left"),
                ["campaign_id", "campaign_name", "channel"])
    out = out.select("campaign_id", "campaign_name", "channel", "sessions", "conversions",
                     "first_conversions", "clicks", "revenue", "cost", "CPS", "CVR", "ROAS")
    if sort:
        out = out.orderBy(F.desc("revenue"), F.desc("sessions"), "campaign_id")
    return out


def campaign_day_performance(campaigns: DataFrame, clicks: DataFrame, sessions: DataFrame,
                             conversions: DataFrame, start_date, end_date,
                             sort: bool = True) -> DataFrame:
    """The full campaign x day grid of ``[start_date, end_date]``, empty days
    included. Columns: campaign_id, campaign_name, channel, date, sessions,
    clicks, conversions, revenue, cost, CPS, CVR, ROAS; sorted by campaign, date.

    The grid is generated per campaign row (``explode`` of the day sequence),
    so it is a projection of the campaign dimension, not a join; its size is
    campaigns x days - exactly the report's size.
    """
    start, end = check_range(start_date, end_date, DAY_PERFORMANCE_MISSING, DAY_PERFORMANCE_ORDER)
    grid = campaigns.select(
        "campaign_id", "campaign_name", "channel",
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))).alias("date"))
    in_clicks, facts = _in_range(clicks, sessions, conversions, start, end)
    sc = _session_measures(facts, ["campaign_id", F.col("session_date").alias("date")])
    cl = _click_measures(in_clicks, ["campaign_id", day_of("click_datetime").alias("date")])
    j = grid.join(sc, ["campaign_id", "date"], "left").join(cl, ["campaign_id", "date"], "left")
    out = _kpis(j, ["campaign_id", "campaign_name", "channel", "date"]).select(
        "campaign_id", "campaign_name", "channel", "date", "sessions", "clicks", "conversions",
        "revenue", "cost", "CPS", "CVR", "ROAS")
    if sort:
        out = out.orderBy("campaign_id", "date")
    return out


DEFAULT_RANGE = (dt.date(2024, 1, 8), dt.date(2024, 1, 21))
