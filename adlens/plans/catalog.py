"""Named queries: every report, view, audit and primitive with its default
parameters, as ``name -> fn(spark, sf_dir) -> DataFrame``.

All of them start from :func:`adlens.sources.model.load_model`, i.e. the whole
stored model tables derived from the input folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.functions.dates import activity_calendar, day_of, in_range
from adlens.functions.ratios import ratio, ratio_or_0
from adlens.operators import audits, cohorts, distincts, facts, insights, reports, upsert, views
from adlens.operators.keys import surrogate_keys
from adlens.operators.topk import top_n
from adlens.sources import schema as S
from adlens.sources.loaders import normalise_label, tagged_load, with_defaults
from adlens.sources.model import Model, load_model

# Defaults inside the test data's month (the warehouse's demo ranges are in
# February/March 2024 and would select nothing here).
REPORT_RANGE = reports.DEFAULT_RANGE
COHORT_RANGE = cohorts.DEFAULT_COHORT_RANGE

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: Callable[[Model], DataFrame]) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(load_model(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return run
    return deco


def catalog() -> dict[str, QueryFn]:
    return dict(_REGISTRY)


# -- shared derived relations ------------------------------------------------

def day_kpis(m: Model) -> DataFrame:
    return views.campaign_day_kpis(m.clicks, m.sessions, m.conversions, m.campaigns)


def cohort(m: Model, cohort_range=(None, None)) -> DataFrame:
    return views.click_cohort(m.clicks, m.sessions, m.conversions, *cohort_range)


def cohort_device(m: Model, cohort_range=(None, None)) -> DataFrame:
    return views.click_cohort_device(m.clicks, m.sessions, m.conversions, *cohort_range)


def _tables(m: Model) -> dict[str, DataFrame]:
    return {name: m.table(name) for name in
            ("campaigns", "users", "clicks", "sessions", "conversions", "costs_daily")}


# -- S1 typed scans ----------------------------------------------------------

for _t in ("campaigns", "users", "clicks", "sessions", "conversions", "costs_daily"):
    query(f"src_{_t}")(lambda m, _t=_t: S.declared(m.table(_t), _t))


# -- views -------------------------------------------------------------------

@query("vw_sessions_enriched")
def _v1(m):
    """V1 - sessions with date, per-user sequence and first-session flag."""
    return views.sessions_enriched(m.sessions)


@query("vw_campaign_day_kpis")
def _v2(m):
    """V2 - click-driven campaign x day KPIs."""
    return day_kpis(m)


@query("vw_click_cohort")
def _v3(m):
    """V3 - campaign x click-day cohorts with D0/D7/D30 conversion."""
    return cohort(m)


@query("vw_click_cohort_device")
def _v4(m):
    """V4 - cohorts split by device (sessions only)."""
    return cohort_device(m)


# -- reports -----------------------------------------------------------------

@query("campaign_performance")
def _r1(m):
    return reports.campaign_performance(m.campaigns, m.clicks, m.sessions, m.conversions, *REPORT_RANGE)


@query("campaign_day_performance")
def _r2(m):
    return reports.campaign_day_performance(m.campaigns, m.clicks, m.sessions, m.conversions, *REPORT_RANGE)


# -- query pack --------------------------------------------------------------

@query("q01_traffic")
def _q1(m):
    return insights.traffic_by_campaign(m.campaigns, m.sessions)


@query("q02_conversions_revenue")
def _q2(m):
    return insights.conversions_revenue_by_campaign(m.campaigns, m.sessions, m.conversions)


@query("q03_kpi_snapshot")
def _q3(m):
    return insights.kpi_snapshot(m.campaigns, m.clicks, m.sessions, m.conversions)


@query("q04_click_day_kpis")
def _q4(m):
    return insights.click_day_kpis(m.campaigns, m.clicks, m.sessions, m.conversions)


@query("q05_conversion_mix")
def _q5(m):
    return insights.conversion_mix(m.conversions)


@query("q06_new_vs_returning")
def _q6(m):
    return insights.new_vs_returning(m.sessions, *REPORT_RANGE)


@query("q07_top_revenue_day")
def _q7(m):
    return insights.top_revenue_day(day_kpis(m))


@query("q08_campaign_totals")
def _q8(m):
    return insights.campaign_totals(day_kpis(m))


@query("q09_trend_from_view")
def _q9(m):
    return insights.trend_from_day_kpis(day_kpis(m))


@query("q10_landing_page_kpis")
def _q10(m):
    return insights.landing_page_kpis(m.campaigns, m.clicks, m.sessions, m.conversions)


@query("q11_device_kpis")
def _q11(m):
    return insights.device_kpis(m.campaigns, m.clicks, m.sessions, m.conversions)


def _respelled(m: Model) -> tuple[DataFrame, DataFrame]:
    """Campaigns and conversions whose labels come in several spellings: campaigns named after their
    channel, and names, channels and types as stored, in capitals or in small letters with blanks behind, by id."""
    def spelled(label: str, id_: Column) -> Column:
        c = F.col(label)
        return F.when(id_ % 3 == 0, c).when(id_ % 3 == 1, F.upper(c)).otherwise(F.concat(F.lower(c), F.lit("  ")))

    k = F.col("campaign_id")
    campaigns = m.campaigns.select("campaign_id", spelled("channel", k).alias("campaign_name"), spelled("channel", F.floor(k / 2)).alias("channel"))
    return campaigns, m.conversions.withColumn("conversion_type", spelled("conversion_type", F.col("conversion_id")))


@query("q01_traffic_spellings")
def _q1_spelled(m):
    """Q1 over labels in several spellings."""
    return insights.traffic_by_campaign(_respelled(m)[0], m.sessions)


@query("q02_conversions_revenue_spellings")
def _q2_spelled(m):
    """Q2 over labels in several spellings."""
    return insights.conversions_revenue_by_campaign(_respelled(m)[0], m.sessions, m.conversions)


@query("q05_conversion_mix_spellings")
def _q5_spelled(m):
    """Q5 over labels in several spellings."""
    return insights.conversion_mix(_respelled(m)[1])


# -- cohort analysis ---------------------------------------------------------

@query("c01_cohort_lift")
def _c1(m):
    return cohorts.cohort_day_lift(cohort(m, COHORT_RANGE), m.campaigns, *COHORT_RANGE)


@query("c02_cohort_campaign")
def _c2(m):
    return cohorts.cohort_campaign_rollup(cohort(m, COHORT_RANGE), m.campaigns, *COHORT_RANGE)


@query("c03_cohort_campaign_device")
def _c3(m):
    return cohorts.cohort_campaign_device_rollup(cohort_device(m, COHORT_RANGE), m.campaigns, *COHORT_RANGE)


# -- upsert ------------------------------------------------------------------

def _upsert(m: Model) -> upsert.UpsertResult:
    return upsert.upsert_costs_daily(m.costs_daily, m.cost_feed, m.campaigns)


@query("costs_upsert_result")
def _m1_table(m):
    """M1 - costs_daily after applying the feed."""
    return _upsert(m).table


@query("costs_upsert_audit")
def _m1_audit(m):
    """M1 - audit log (the wall-clock ``timestamp`` column is left out)."""
    return _upsert(m).audit.drop("timestamp")


@query("cost_feed_rejects")
def _m1_rejects(m):
    """M1 - rejected feed rows with the first failing check."""
    return _upsert(m).rejects


@query("cost_feed_conflicts")
def _m1_conflicts(m):
    """M1 - a feed that names keys again: the keys of the last five of a month are fed twice, some with
    another cost; none of their rows is applied."""
    again = m.cost_feed.filter(F.dayofmonth("cost_date") > 25)
    twice = again.withColumn("cost", F.col("cost") + F.pmod("campaign_id", F.lit(2)))
    got = upsert.upsert_costs_daily(m.costs_daily, m.cost_feed.unionByName(twice), m.campaigns)
    kept = got.table.groupBy("cost_date").agg(F.count(F.lit(1)).alias("table_rows"), facts.money_sum("cost").alias("table_cost"))
    found = got.conflicts.groupBy("cost_date").agg(F.sum("rows").alias("conflict_rows"), F.count(F.lit(1)).alias("conflict_costs"))
    return kept.join(found, "cost_date", "full_outer")


# -- audits ------------------------------------------------------------------

@query("audit_pk")
def _a1(m):
    return audits.audit_pk(_tables(m))


@query("audit_fk")
def _a2(m):
    return audits.audit_fk(_tables(m))


@query("audit_check")
def _a3(m):
    return audits.audit_check(_tables(m))


@query("audit_not_null")
def _a4(m):
    return audits.audit_not_null(_tables(m))


@query("audit_feed_as_costs")
def _a_dirty(m):
    """All four audit families over the raw upsert feed loaded as costs_daily
    (it holds NULLs, negative costs, unknown campaigns and repeated keys)."""
    t = {"campaigns": m.campaigns, "costs_daily": m.cost_feed}
    return reduce(DataFrame.unionByName, [
        audits.audit_pk(t), audits.audit_fk(t), audits.audit_check(t), audits.audit_not_null(t)])


def _spoiled(df: DataFrame, id_, nulls: list[str], changes: dict[str, tuple[int, object]]) -> DataFrame:
    """``df`` with violations, dealt by the remainder r of ``id_`` and 11: the
    i-th column of ``nulls`` is NULL where r = i, rows with r = 5 occur
    twice, and a column of ``changes`` takes its value where r is the number given."""
    rows = df.withColumn("_r", F.pmod(id_, F.lit(11)))
    rows = rows.unionByName(rows.filter("_r = 5"))
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in nulls:
            c = F.when(F.col("_r") != nulls.index(f.name), c)
        if f.name in changes:
            at, value = changes[f.name]
            value = value if isinstance(value, Column) else F.lit(value)
            c = F.when(F.col("_r") == at, value.cast(f.dataType.simpleString())).otherwise(c)
        out.append(c.alias(f.name))
    return rows.select(*out)


def _dirty_tables(m: Model) -> dict[str, DataFrame]:
    """The model's tables with violations of every constraint."""
    changes = {
        "campaigns": {},
        "users": {"registration_date": (6, F.date_sub("first_seen_date", 1))},
        "clicks": {"campaign_id": (6, -1)},
        "sessions": {"user_id": (6, -1), "campaign_id": (7, -1), "click_id": (8, -1)},
        "conversions": {"session_id": (6, -1), "conversion_type": (7, "Refund"), "revenue": (8, -1)},
        "costs_daily": {"campaign_id": (6, -1), "cost": (7, -1)},
    }
    ids = {name: F.col(S.PRIMARY_KEYS[name][0]) for name in changes}
    ids["costs_daily"] = F.dayofmonth("cost_date") + F.col("campaign_id")
    return {name: _spoiled(m.table(name), ids[name], S.not_null_columns(name), changes[name]) for name in changes}


@query("audit_pk_dirty")
def _a1_dirty(m):
    """A1 over tables with repeated and missing keys."""
    return audits.audit_pk(_dirty_tables(m))


@query("audit_fk_dirty")
def _a2_dirty(m):
    """A2 over tables with references to absent rows."""
    return audits.audit_fk(_dirty_tables(m))


@query("audit_check_dirty")
def _a3_dirty(m):
    """A3 over tables with values outside their checks."""
    return audits.audit_check(_dirty_tables(m))


@query("audit_not_null_dirty")
def _a4_dirty(m):
    """A4 over tables with a NULL in every NOT NULL column."""
    return audits.audit_not_null(_dirty_tables(m))


@query("recon_orphan_clicks")
def _recon1(m):
    return audits.orphan_clicks(m.clicks, m.sessions)


@query("recon_sessions_outside_view")
def _recon2(m):
    return audits.sessions_outside_day_view(m.clicks, m.sessions)


# -- top-k -------------------------------------------------------------------

@query("top5_campaigns")
def _o1a(m):
    return top_n(m.campaigns, 5, ["campaign_id"])


@query("top5_clicks")
def _o1b(m):
    return top_n(S.declared(m.clicks, "clicks"), 5, ["click_datetime", "click_id"])


@query("top5_sessions")
def _o1c(m):
    return top_n(S.declared(m.sessions, "sessions"), 5, ["session_datetime", "session_id"])


@query("top5_conversions")
def _o1d(m):
    return top_n(S.declared(m.conversions, "conversions"), 5, ["conversion_datetime", "conversion_id"])


@query("top5_costs_daily")
def _o1e(m):
    return top_n(m.costs_daily, 5, ["cost_date", "campaign_id"])


@query("top50_campaign_day")
def _o2a(m):
    return top_n(day_kpis(m), 50, [F.desc("activity_date"), "campaign_id"])


@query("top50_cohort")
def _o2b(m):
    return top_n(cohort(m), 50, ["campaign_id", "cohort_date"])


@query("top50_cohort_device")
def _o2c(m):
    return top_n(cohort_device(m), 50, ["campaign_id", "cohort_date", "device"])


# -- primitives --------------------------------------------------------------

@query("surrogate_keys")
def _s6(m):
    """S6 - dense 1-based load keys for conversions in time order."""
    return surrogate_keys(m.conversions.select("conversion_id", "conversion_datetime"),
                          ["conversion_datetime", "conversion_id"], "load_key")


@query("load_defaults")
def _s5(m):
    """S5 - a session feed without the device column takes the default."""
    feed = m.sessions.drop("device")
    return with_defaults(feed, "sessions").groupBy("device").agg(F.count(F.lit(1)).alias("sessions"))


def _routed(load: str, tagged: DataFrame, money: str | None) -> DataFrame:
    """Rows and money of a load by the constraints that they fail ('': accepted)."""
    total = facts.money_sum(money) if money else F.lit(None).cast(S.MONEY_SUM_DDL)
    return tagged.groupBy(F.array_join("failed", "+").alias("failed")).agg(F.count(F.lit(1)).alias("rows"), total.alias("money")) \
        .select(F.lit(load).alias("load"), "failed", "rows", "money")


@query("load_routing")
def _s2_routing(m):
    """S2 - loads with violations of every constraint, routed in one pass by what each row fails."""
    dirty, clean = _dirty_tables(m), _tables(m)
    return reduce(DataFrame.unionByName, [
        _routed(name, tagged_load(S.declared(dirty[name], name), name, clean), money)
        for name, money in (("users", None), ("clicks", "cost"), ("sessions", None), ("conversions", "revenue"), ("costs_daily", "cost"))])


@query("load_money_defaults")
def _s5_money(m):
    """S5 - loads without their money or device column: defaults first, then the constraints."""
    parents = _tables(m)
    loads = {"conversions": "revenue", "costs_daily": "cost", "sessions": "device"}
    return reduce(DataFrame.unionByName, [
        _routed(name, tagged_load(S.declared(m.table(name), name).drop(col), name, parents), col if col != "device" else None)
        for name, col in loads.items()])


@query("device_normalised")
def _p10(m):
    """P10 - sessions per case/space-insensitive device label."""
    return m.sessions.groupBy(normalise_label("device").alias("device")).agg(
        F.count(F.lit(1)).alias("sessions"))


@query("date_series")
def _date_series(m):
    """The activity calendar: every day from the first to the last session
    day (the day series the grid report is built on, over the data's span)."""
    return activity_calendar(m.sessions, "session_datetime")


@query("session_facts")
def _session_facts(m):
    """Per-session conversion totals and first-session flag (the core frame)."""
    return facts.session_facts(m.sessions, m.conversions, new_flag=True)


@query("daily_activity")
def _daily_activity(m):
    """Session campaign-days (session-day attribution, all sessions)."""
    return views.session_day_activity(m.sessions, m.conversions)


@query("clicks_with_session")
def _clicks_with_session(m):
    """P5/J7 - clicks left-joined to sessions, keeping those with a session."""
    j = m.clicks.join(m.sessions.select("click_id", "session_id"), "click_id", "left")
    return j.filter(F.col("session_id").isNotNull()).select("click_id", "campaign_id", "session_id")


@query("ratio_policies")
def _ratio_policies(m):
    """P8/P9 - both zero policies side by side on the daily click grid."""
    d = facts.daily_clicks(m.clicks)
    return d.select("campaign_id", "activity_date", "clicks", "cost",
                    ratio("clicks", "cost").alias("clicks_per_cost"),
                    ratio_or_0("clicks", "cost").alias("clicks_per_cost_or_0"))


@query("date_range_filter")
def _date_range_filter(m):
    """P4 - sessions per day inside the default range (inclusive ends)."""
    s = m.sessions.filter(in_range(day_of("session_datetime"), *REPORT_RANGE))
    return s.groupBy(day_of("session_datetime").alias("session_date")).agg(F.count(F.lit(1)).alias("sessions"))


@query("session_flags")
def _p3(m):
    """P3 - per session: first-ever (new) or returning flag."""
    f = facts.first_sessions(m.sessions)
    j = m.sessions.select("session_id", "user_id").join(f, "session_id", "left")
    new = F.coalesce(F.col("is_new_user_session"), F.lit(0))
    return j.select("session_id", "user_id", new.alias("is_new_user_session"),
                    (1 - new).alias("is_returning_session"))


def _campaign_conversion_totals(m: Model) -> DataFrame:
    per = facts.session_facts(m.sessions.select("session_id", "campaign_id", "session_datetime"), m.conversions)
    agg = per.groupBy("campaign_id").agg(F.count(F.lit(1)).alias("sessions"), F.sum("conversions").alias("conversions"))
    return m.campaigns.select("campaign_id").join(agg, "campaign_id", "left").select(
        "campaign_id", F.coalesce("sessions", F.lit(0)).alias("sessions"),
        F.coalesce("conversions", F.lit(0)).alias("conversions"))


@query("ratio_null_policy")
def _p8(m):
    """P8 - conversions per session per campaign, NULL for an idle campaign."""
    t = _campaign_conversion_totals(m)
    return t.select("*", ratio("conversions", "sessions").alias("CPS"))


@query("ratio_zero_policy")
def _p9(m):
    """P9 - the same ratio with 0.00 for an idle campaign."""
    t = _campaign_conversion_totals(m)
    return t.select("*", ratio_or_0("conversions", "sessions").alias("CPS"))


@query("join_inner_dim")
def _j1(m):
    """J1 - click-day aggregate joined to the campaign dimension (inner)."""
    return facts.daily_clicks(m.clicks).join(
        m.campaigns.select("campaign_id", "campaign_name", "channel"), "campaign_id", "inner")


@query("join_session_click")
def _j2(m):
    """J2 - sessions joined to their click: the click's campaign and day."""
    s = m.sessions.filter(F.col("click_id").isNotNull()).select("session_id", "click_id")
    c = m.clicks.select("click_id", F.col("campaign_id").alias("click_campaign_id"),
                        day_of("click_datetime").alias("click_date"))
    return s.join(c, "click_id", "inner")


@query("join_left_keep_all")
def _j4(m):
    """J4 - every campaign with its session count (idle campaigns kept, 0)."""
    per = m.sessions.groupBy("campaign_id").agg(F.count(F.lit(1)).alias("sessions"))
    return m.campaigns.select("campaign_id", "campaign_name").join(per, "campaign_id", "left").select(
        "campaign_id", "campaign_name", F.coalesce("sessions", F.lit(0)).alias("sessions"))


@query("join_left_composite")
def _j5(m):
    """J5 - click days left-joined to session days on (campaign, date)."""
    c = facts.daily_clicks(m.clicks).select("campaign_id", "activity_date", "clicks")
    s = m.sessions.groupBy("campaign_id", day_of("session_datetime").alias("activity_date")).agg(
        F.count(F.lit(1)).alias("sessions"))
    return c.join(s, ["campaign_id", "activity_date"], "left").select(
        "campaign_id", "activity_date", "clicks", F.coalesce("sessions", F.lit(0)).alias("sessions"))


@query("join_click_session_left")
def _j7(m):
    """J7 - every click with its session (NULL for orphan clicks)."""
    s = m.sessions.filter(F.col("click_id").isNotNull()).select("click_id", "session_id")
    return m.clicks.select("click_id", "campaign_id").join(s, "click_id", "left")


@query("campaign_date_grid")
def _j9(m):
    """J9 - campaign x day grid of the default range (generated per campaign)."""
    return m.campaigns.select(
        "campaign_id", F.explode(F.sequence(F.lit(REPORT_RANGE[0]), F.lit(REPORT_RANGE[1]),
                                            F.expr("INTERVAL 1 DAY"))).alias("date"))


@query("agg_basic")
def _g1(m):
    """G1/G2/G5 - COUNT(*), COUNT(col) and SUM per campaign over clicks."""
    return m.clicks.groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count("cost").alias("priced_clicks"),
        facts.money_sum("cost").alias("cost"))


@query("agg_distinct")
def _g3(m):
    """G3 - exact COUNT(DISTINCT user_id) of sessions per campaign."""
    return m.sessions.groupBy("campaign_id").agg(F.countDistinct("user_id").alias("users"))


@query("agg_distinct_conditional")
def _g4(m):
    """G4 - per session day: distinct sessions and distinct converted sessions."""
    per = facts.session_facts(m.sessions.select("session_id", "session_datetime"), m.conversions)
    return per.groupBy("session_date").agg(
        F.count("session_id").alias("sessions"), F.sum("converted").alias("converted_sessions"))


@query("agg_distinct_rollup")
def _g3_rollup(m):
    """G3 - exact distinct users by day, by campaign and overall, from one aggregate of bitmaps."""
    maps = distincts.id_bitmaps(m.sessions, [day_of("session_datetime").alias("session_date"), "campaign_id"], "user_id")
    grains = {"day": ["session_date"], "campaign": ["campaign_id"], "all": []}
    return reduce(DataFrame.unionByName, [
        distincts.distinct_ids(maps, keys, "users").select(
            F.lit(grain).alias("grain"),
            *[(F.col(c) if c in keys else F.lit(None)).cast(kind).alias(c) for c, kind in (("session_date", "date"), ("campaign_id", "int"))],
            "users") for grain, keys in grains.items()])


@query("first_conversion_per_session")
def _g6(m):
    """G6 - first conversion id of every session that converted."""
    return facts.conversions_per_session(m.conversions).select("session_id", "first_conversion_id")


@query("two_level_conversion_agg")
def _g7(m):
    """G7 - per session, then per campaign: conversions, converted sessions, revenue."""
    per = facts.session_facts(m.sessions.select("session_id", "campaign_id", "session_datetime"), m.conversions)
    return per.groupBy("campaign_id").agg(
        F.sum("conversions").alias("conversions"), F.sum("converted").alias("first_conversions"),
        facts.money_total("revenue").alias("revenue"))


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Expose the model tables and the four derived relations as temp views
    (``campaigns`` ... ``vw_sessions_enriched``, ``vw_campaign_day_kpis``,
    ``vw_click_cohort``, ``vw_click_cohort_device``) for SQL users."""
    m = load_model(spark, sf_dir)
    m.register()
    views.sessions_enriched(m.sessions).createOrReplaceTempView("vw_sessions_enriched")
    day_kpis(m).createOrReplaceTempView("vw_campaign_day_kpis")
    cohort(m).createOrReplaceTempView("vw_click_cohort")
    cohort_device(m).createOrReplaceTempView("vw_click_cohort_device")
    # The cohort relations under their warehouse names as well, so existing
    # SQL keeps working unchanged.
    cohort(m).createOrReplaceTempView("vw_click_cohort_cvr_d0_d7_d30")
    cohort_device(m).createOrReplaceTempView("vw_click_cohort_device_cvr_d0_d7_d30")
