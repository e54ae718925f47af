"""Per-session and per-day fact frames that every report starts from.

The shape is always "aggregate the fact side first, then join": conversions
are reduced to one row per session before meeting sessions, clicks to one row
per (campaign, day) before meeting anything. Partial (map-side) aggregation
absorbs hot sessions or campaigns before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions.dates import day_of
from adlens.sources import schema as S
from adlens.sources.schema import MONEY_SUM_DDL as MONEY_SUM


def money_sum(col: str | Column) -> Column:
    """``SUM`` of a DECIMAL(10,2) column as DECIMAL(18,2) (NULL on no rows)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c).cast(MONEY_SUM)


def money_total(col: str | Column) -> Column:
    """``ISNULL(SUM(x), 0)`` for money."""
    return F.coalesce(money_sum(col), F.lit(0).cast(MONEY_SUM))


def conversions_per_session(conversions: DataFrame) -> DataFrame:
    """session_id -> conversions, first_conversion_id, revenue (one row per
    session that has conversions)."""
    return conversions.groupBy("session_id").agg(
        F.count("conversion_id").alias("conversions"),
        F.min("conversion_id").alias("first_conversion_id"),
        money_sum("revenue").alias("revenue"),
    )


def _time_then_id(ts: str, id_: str) -> Column:
    """A number that orders like (time, id): microseconds since 1970, then the id."""
    t = F.col(ts)
    micros = (F.unix_date(day_of(t)).cast("long") * 86_400 + F.hour(t) * 3_600 + F.minute(t) * 60).cast("decimal(18,0)") \
        * 1_000_000 + (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("decimal(8,0)")
    # ids lie within +-2^63, less than half of the step
    return (micros.cast("decimal(18,0)") * F.lit("20000000000000000000").cast("decimal(20,0)") + F.col(id_).cast("decimal(19,0)")) \
        .cast("decimal(38,0)")


def first_sessions(sessions: DataFrame) -> DataFrame:
    """session_id of every user's first session ever (earliest time, then
    lowest id). A per-user MIN_BY aggregates map-side, so a user with millions of
    sessions costs one partial row per task, unlike a per-user window. Time and
    id are one DECIMAL, which keeps the aggregate hash-based (a struct would sort the
    raw rows in each map task)."""
    first = sessions.groupBy("user_id").agg(
        F.min_by("session_id", _time_then_id("session_datetime", "session_id")).alias("session_id"))
    return first.select("session_id", F.lit(1).alias("is_new_user_session"))


def session_facts(sessions: DataFrame, conversions: DataFrame, new_flag: bool = False,
                  history: DataFrame | None = None) -> DataFrame:
    """One row per session with its conversion totals.

    Columns: the session's declared columns, ``session_date``, ``conversions``
    (0 when none), ``converted`` (1 when at least one conversion),
    ``revenue`` (0.00 when none) and, with ``new_flag``, ``is_new_user_session``
    (first session of the user over ``history``, default all of ``sessions``;
    pass the unfiltered table when ``sessions`` is date-filtered).
    All joins are on ``session_id`` - a unique key - so they co-partition.
    """
    per = conversions_per_session(conversions)
    out = sessions.join(per, "session_id", "left")
    if new_flag:
        out = out.join(first_sessions(history if history is not None else sessions), "session_id", "left")
    cols = [
        *[F.col(c) for c in sessions.columns if c not in S.DAY_COLUMNS.values()],
        day_of("session_datetime").alias("session_date"),
        F.coalesce(F.col("conversions"), F.lit(0)).alias("conversions"),
        F.col("first_conversion_id").isNotNull().cast("int").alias("converted"),
        F.coalesce(F.col("revenue"), F.lit(0).cast(MONEY_SUM)).alias("revenue"),
    ]
    if new_flag:
        cols.append(F.coalesce(F.col("is_new_user_session"), F.lit(0)).alias("is_new_user_session"))
    return out.select(*cols)


def daily_clicks(clicks: DataFrame) -> DataFrame:
    """(campaign_id, activity_date) -> clicks, cost (cost NULL when every
    click of the day has no cost)."""
    return clicks.groupBy("campaign_id", day_of("click_datetime").alias("activity_date")).agg(
        F.count("click_id").alias("clicks"),
        money_sum("cost").alias("cost"),
    )
