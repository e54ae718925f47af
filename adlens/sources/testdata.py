"""Derive the campaign model from the driver's generic parquet tables.

The driver ships a star schema plus an ``events`` stream (view / click /
purchase / signup / error, with ``props = {"k": 0..99}``), not campaign tables.
This module maps them onto the model; every rule is deterministic so the
DuckDB oracle can rebuild the same tables from the same files.

Mapping (``k`` = the integer in ``props``, ``camp = k % 24``,
``v = CAST(value AS DECIMAL(10,2))``):

* campaigns   - one per nation: id = nation key, name = nation name, channel =
                region name; start date 2024-01-01, NULL when key % 4 = 3.
                Campaign 24 never appears in events (an idle campaign).
* users       - every events user; first seen = first event day, registration
                = first signup day, country = customer's nation, gender by
                ``user_id % 4`` (Female, Male, Other, NULL).
* clicks      - click events with camp <> 23; cost 0.00 for camp 22, NULL for
                camp 21 when ``event_id % 4 = 0``, else v.
* sessions    - view events. The user's i-th view is linked to the user's i-th
                kept click when that click is not later than the view, else it
                is a direct session. Campaign = linked click's campaign, except
                ``event_id % 10 = 0`` and direct sessions keep camp. Device and
                landing page from ``event_id % 3`` and ``event_id % 8``.
* conversions - purchase / signup events, attached to the user's last view
                before them (dropped when there is none). purchase ->
                Purchase (revenue v), even signup id -> Registration, odd ->
                Lead (revenue 0).
* costs_daily - the stored daily-cost table as it stands before the feed
                arrives: click cost per (day, campaign) for the even days of
                the month, so applying the feed both updates and inserts.
* cost_feed   - the same rollup on every day plus 1.00 (updates and inserts)
                and invalid rows built from error events with k in 95..99.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.operators.sequence import running_sums
from adlens.sources.schema import MONEY_DDL as MONEY
from adlens.sources.schema import MONEY_SUM_DDL as MONEY_SUM

# Fixed values of the mapping.
N_CAMPAIGN_SLOTS = 24            # camp = k % 24
NO_CLICK_CAMPAIGN = 23           # clicks of this campaign are dropped
ZERO_COST_CAMPAIGN = 22          # clicks of this campaign cost 0.00
NULL_COST_CAMPAIGN = 21          # some clicks of this campaign have no cost
GENDERS = ("Female", "Male", "Other")                     # user_id % 4 = 0, 1, 2; 3 -> NULL
DEVICES = ("Mobile", "Desktop", "Unknown")                # event_id % 3
LANDING_PAGES = ("/home", "/pricing", "/blog", "/landing",
                 "/services", "/contact", "/about")       # event_id % 8; 7 -> NULL
CAMPAIGN_START = "2024-01-01"
UNKNOWN_CAMPAIGN = 999


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    """``values[index]``, NULL when ``index`` is past the end."""
    expr = None
    for i, v in enumerate(values):
        expr = (F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v)))
    return expr.otherwise(F.lit(None).cast("string"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = driver_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    return ev.select(
        "event_id", "ts", "user_id", "event_type",
        k.alias("k"),
        (k % N_CAMPAIGN_SLOTS).alias("camp"),
        F.col("value").cast(MONEY).alias("v"),
    )


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = driver_table(spark, sf_dir, "nation")
    region = driver_table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "inner").select(
        F.col("n_nationkey").cast("int").alias("campaign_id"),
        F.col("n_name").alias("campaign_name"),
        F.col("r_name").alias("channel"),
        F.when(F.col("n_nationkey") % 4 == 3, F.lit(None).cast("date"))
         .otherwise(F.lit(CAMPAIGN_START).cast("date")).alias("start_date"),
    )


def users(spark: SparkSession, sf_dir: str, ev: DataFrame) -> DataFrame:
    customer = driver_table(spark, sf_dir, "customer")
    nation = driver_table(spark, sf_dir, "nation")
    per_user = ev.groupBy("user_id").agg(
        F.min("ts").cast("date").alias("first_seen_date"),
        F.min(F.when(F.col("event_type") == "signup", F.col("ts"))).cast("date").alias("registration_date"),
    )
    country = (customer.select(F.col("c_custkey").alias("user_id"), "c_nationkey")
               .join(nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")),
                     "c_nationkey", "inner")
               .select("user_id", "country"))
    return per_user.join(country, "user_id", "left").select(
        "user_id", "first_seen_date", "registration_date", "country",
        _pick(F.col("user_id") % 4, GENDERS).alias("gender"),
    )


def _click_cost() -> Column:
    return (F.when(F.col("camp") == ZERO_COST_CAMPAIGN, F.lit(0).cast(MONEY))
             .when((F.col("camp") == NULL_COST_CAMPAIGN) & (F.col("event_id") % 4 == 0),
                   F.lit(None).cast(MONEY))
             .otherwise(F.col("v")))


def _is_kept_click() -> Column:
    return (F.col("event_type") == "click") & (F.col("camp") != NO_CLICK_CAMPAIGN)


def clicks(ev: DataFrame) -> DataFrame:
    return ev.filter(_is_kept_click()).select(
        F.col("event_id").alias("click_id"),
        F.col("camp").cast("int").alias("campaign_id"),
        F.col("ts").alias("click_datetime"),
        _click_cost().alias("cost"),
    )


def sessions_and_conversions(ev: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """Sessions (with click links) and conversions (with session links).

    One ordered pass over each user's view / click / conversion events counts
    the views and kept clicks up to every row; the i-th view and i-th click
    then meet on ``(user_id, i)`` and a conversion meets the view numbered
    "views so far". Both joins are on unique keys, so no user is a hot key. Four
    frames start from the counted events; ``keep`` may write them once.
    """
    stream = ev.filter(F.col("event_type").isin("view", "click", "purchase", "signup")).select(
        "user_id", "ts", "event_id", "event_type", "camp", "v",
        (F.col("event_type") == "view").cast("int").alias("is_view"),
        _is_kept_click().cast("int").alias("is_click"),
    )
    counted = running_sums(stream, "user_id", ["ts", "event_id"],
                           {"views_upto": "is_view", "clicks_upto": "is_click"})
    counted = keep(counted)

    views = counted.filter(F.col("is_view") == 1).select(
        "user_id", "ts", "event_id", "camp", F.col("views_upto").alias("seq"))
    kept = counted.filter(F.col("is_click") == 1).select(
        "user_id",
        F.col("clicks_upto").alias("seq"),
        F.col("event_id").alias("link_click_id"),
        F.col("ts").alias("link_ts"),
        F.col("camp").alias("link_camp"),
    )
    linked = views.join(kept, ["user_id", "seq"], "left")
    click_id = F.when(F.col("link_ts") <= F.col("ts"), F.col("link_click_id"))
    sessions = linked.select(
        F.col("event_id").alias("session_id"),
        "user_id",
        F.when(click_id.isNotNull() & (F.col("event_id") % 10 != 0), F.col("link_camp"))
         .otherwise(F.col("camp")).cast("int").alias("campaign_id"),
        click_id.alias("click_id"),
        _pick(F.col("event_id") % 3, DEVICES).alias("device"),
        _pick(F.col("event_id") % 8, LANDING_PAGES).alias("landing_page"),
        F.col("ts").alias("session_datetime"),
    )

    convs = counted.filter(F.col("event_type").isin("purchase", "signup") & (F.col("views_upto") > 0))
    conversions = convs.join(
        views.select("user_id", F.col("seq").alias("views_upto"), F.col("event_id").alias("session_id"),
                     F.col("ts").cast("date").alias("session_day")),
        ["user_id", "views_upto"], "inner",
    ).select(
        F.col("event_id").alias("conversion_id"),
        "session_id",
        F.col("ts").alias("conversion_datetime"),
        F.when(F.col("event_type") == "purchase", F.lit("Purchase"))
         .when(F.col("event_id") % 2 == 0, F.lit("Registration"))
         .otherwise(F.lit("Lead")).alias("conversion_type"),
        F.when(F.col("event_type") == "purchase", F.col("v"))
         .otherwise(F.lit(0).cast(MONEY)).alias("revenue"),
        "session_day",
    )
    return sessions, conversions


def _daily_click_cost(clk: DataFrame) -> DataFrame:
    return clk.groupBy(F.col("click_datetime").cast("date").alias("cost_date"), "campaign_id").agg(
        F.sum(F.coalesce(F.col("cost"), F.lit(0).cast(MONEY))).cast(MONEY_SUM).alias("cost"))


def costs_daily(clk: DataFrame) -> DataFrame:
    daily = _daily_click_cost(clk)
    return daily.filter(F.dayofmonth("cost_date") % 2 == 0).select("cost_date", "campaign_id", "cost")


def cost_feed(clk: DataFrame, ev: DataFrame) -> DataFrame:
    """Upsert input: corrected costs for every day plus invalid rows."""
    good = _daily_click_cost(clk).select(
        "cost_date", "campaign_id", (F.col("cost") + F.lit(1)).cast(MONEY_SUM).alias("cost"))
    err = ev.filter((F.col("event_type") == "error") & (F.col("k") >= 95))
    day = F.col("ts").cast("date")
    camp = F.col("camp").cast("int")
    bad = err.select(
        F.when(F.col("k") == 96, F.lit(None).cast("date")).otherwise(day).alias("cost_date"),
        F.when(F.col("k") == 97, F.lit(UNKNOWN_CAMPAIGN))
         .when(F.col("k") == 99, F.lit(None).cast("int")).otherwise(camp).alias("campaign_id"),
        F.when(F.col("k").isin(95, 99), F.lit(None).cast(MONEY_SUM))
         .when(F.col("k") == 98, -F.col("v")).otherwise(F.col("v")).cast(MONEY_SUM).alias("cost"),
    )
    return good.unionByName(bad)


def derive_model(spark: SparkSession, sf_dir: str, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> dict[str, DataFrame]:
    """All model tables (plus the upsert feed) as lazy DataFrames."""
    ev = events(spark, sf_dir)
    clk = clicks(ev)
    sess, conv = sessions_and_conversions(ev, keep)
    return {
        "campaigns": campaigns(spark, sf_dir),
        "users": users(spark, sf_dir, ev),
        "clicks": clk,
        "sessions": sess,
        "conversions": conv,
        "costs_daily": costs_daily(clk),
        "cost_feed": cost_feed(clk, ev),
    }
