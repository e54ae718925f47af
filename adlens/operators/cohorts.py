"""Cohort analysis over the click cohorts: per-day lift, weighted rollups.

Rollups are ratio-of-sums (never averages of daily rates). C2/C3 lifts are
taken from the unrounded quotients and rounded once; the per-day lift of C1 is
the difference of the cohort relation's already-rounded rates.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.functions.dates import date_bounds, in_range
from adlens.functions.labels import one_spelling
from adlens.functions.ratios import cohort_lift, cohort_ratio, rate_difference

DEFAULT_COHORT_RANGE = (dt.date(2024, 1, 1), dt.date(2024, 1, 28))


def cohort_day_lift(cohort: DataFrame, campaigns: DataFrame, cohort_start, cohort_end) -> DataFrame:
    """C1 - per (campaign, cohort day) converted sessions, rates and lifts."""
    start, end = date_bounds(cohort_start, cohort_end, 50010)
    v = cohort.filter(in_range("cohort_date", start, end))
    j = v.join(campaigns.select("campaign_id", "campaign_name"), "campaign_id", "inner")
    return j.select(
        "cohort_date", "campaign_id", "campaign_name",
        "sessions_converted_D0", "sessions_converted_D7", "sessions_converted_D30",
        "CVR_D0", "CVR_D7", "CVR_D30",
        rate_difference("CVR_D7", "CVR_D0").alias("lift_0_to_7"),
        rate_difference("CVR_D30", "CVR_D7").alias("lift_7_to_30"),
    ).orderBy("campaign_id", "cohort_date")


def _rollup(cohort: DataFrame, keys: list[str], start: dt.date, end: dt.date) -> DataFrame:
    return cohort.filter(in_range("cohort_date", start, end)).groupBy(*keys).agg(
        F.sum("sessions").alias("total_sessions"),
        F.sum("sessions_converted_D0").alias("conv_sessions_D0"),
        F.sum("sessions_converted_D7").alias("conv_sessions_D7"),
        F.sum("sessions_converted_D30").alias("conv_sessions_D30"),
    )


def _weighted(df: DataFrame) -> list:
    return [
        cohort_ratio("conv_sessions_D0", "total_sessions").alias("CVR_D0"),
        cohort_ratio("conv_sessions_D7", "total_sessions").alias("CVR_D7"),
        cohort_ratio("conv_sessions_D30", "total_sessions").alias("CVR_D30"),
        cohort_lift("conv_sessions_D7", "conv_sessions_D0", "total_sessions").alias("lift_0_to_7"),
        cohort_lift("conv_sessions_D30", "conv_sessions_D7", "total_sessions").alias("lift_7_to_30"),
    ]


def cohort_campaign_rollup(cohort: DataFrame, campaigns: DataFrame, cohort_start, cohort_end) -> DataFrame:
    """C2 - weighted CVR and lift per campaign over the cohort days."""
    start, end = date_bounds(cohort_start, cohort_end, 50010)
    r = _rollup(cohort, ["campaign_id"], start, end)
    j = r.join(campaigns.select("campaign_id", "campaign_name"), "campaign_id", "inner")
    return j.select(
        "campaign_id", "campaign_name", "total_sessions",
        "conv_sessions_D0", "conv_sessions_D7", "conv_sessions_D30", *_weighted(j),
    ).orderBy(F.desc("CVR_D7"), F.desc("total_sessions"), "campaign_id")


def cohort_campaign_device_rollup(cohort_device: DataFrame, campaigns: DataFrame,
                                  cohort_start, cohort_end) -> DataFrame:
    """C3 - weighted CVR and lift per (campaign, device)."""
    start, end = date_bounds(cohort_start, cohort_end, 50010)
    r = _rollup(cohort_device, ["campaign_id", "device"], start, end)
    r = one_spelling(r, ["campaign_id"], "device", [F.sum(c).alias(c) for c in (
        "total_sessions", "conv_sessions_D0", "conv_sessions_D7", "conv_sessions_D30")])
    j = r.join(campaigns.select("campaign_id", "campaign_name"), "campaign_id", "inner")
    return j.select(
        "campaign_id", "campaign_name", "device", "total_sessions", "conv_sessions_D7", *_weighted(j),
    ).orderBy("campaign_id", F.desc("lift_0_to_7"), F.desc("total_sessions"), "device")
