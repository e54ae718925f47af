"""Loads: constraints routed in one pass, defaults first; full refresh; foreign keys without a hot task; distinct counts."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from adlens.operators import audits, distincts
from adlens.plans.catalog import catalog
from adlens.sources import loaders
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1, 10)
SESSIONS = "session_id long"


def conversions(spark, rows, cols="conversion_id long, session_id long, conversion_datetime timestamp_ntz, conversion_type string, revenue decimal(10,2)"):
    return spark.createDataFrame(rows, cols)


def test_every_reason_and_what_is_accepted(spark, tmp_path):
    parents = {"sessions": spark.createDataFrame([(1,), (2,)], SESSIONS)}
    feed = conversions(spark, [
        (1, 1, T0, "Lead", Decimal("0.00")), (2, 9, T0, "Lead", Decimal("1.00")), (3, 2, T0, "Refund", Decimal("-1.00")),
        (4, None, None, "Lead", None), (None, 1, T0, "Lead", Decimal("1.00")), (5, 1, T0, "Lead", Decimal("1.00")),
        (5, 1, T0, "Lead", Decimal("1.00")), (6, 2, T0, None, Decimal("2.00"))])
    ok, bad = loaders.load_checked(feed, "conversions", parents, str(tmp_path / "load"))
    assert [tuple(r) for r in ok.collect()] == [(1, 1, T0, "Lead", Decimal("0.00"))]
    assert sorted((r.conversion_id or 0, r.failed) for r in bad.collect()) == [
        (0, ["nn_conversion_id"]), (2, ["fk_session_id_sessions"]), (3, ["ck_conversion_type", "ck_revenue_nonneg"]),
        (4, ["nn_session_id", "nn_conversion_datetime", "nn_revenue"]), (5, ["pk_conversion_id"]), (5, ["pk_conversion_id"]),
        (6, ["nn_conversion_type"])]
    assert ok.schema["revenue"].dataType.simpleString() == "decimal(10,2)"


def test_defaults_come_before_constraints(spark):
    feed = conversions(spark, [(1, 1, T0, "Lead")], "conversion_id long, session_id long, conversion_datetime timestamp_ntz, conversion_type string")
    got = loaders.tagged_load(feed, "conversions", {}).first()
    assert got.revenue == Decimal("0.00") and got.failed == []
    costs = spark.createDataFrame([(dt.date(2024, 1, 1), 1)], "cost_date date, campaign_id int")
    assert loaders.tagged_load(costs, "costs_daily", {}).first().cost == Decimal("0.00")


def test_empty_load_and_composite_key(spark, tmp_path):
    ok, bad = loaders.load_checked(conversions(spark, []), "conversions", {}, str(tmp_path / "a"))
    assert ok.count() == bad.count() == 0
    costs = spark.createDataFrame([(dt.date(2024, 1, 1), 1, Decimal(1))] * 2 + [(dt.date(2024, 1, 1), None, Decimal(1))] * 2,
                                  "cost_date date, campaign_id int, cost decimal(18,2)")
    assert sorted(r.failed for r in loaders.tagged_load(costs, "costs_daily", {}).collect()) == \
        [["nn_campaign_id"]] * 2 + [["pk_cost_date_campaign_id"]] * 2


def test_full_refresh_and_append(spark, tmp_path):
    first, second = (conversions(spark, [(k, 1, T0, "Lead", Decimal(k))]) for k in (1, 2))
    where = str(tmp_path / "v1")
    loaders.refresh_table(first, "conversions", where)
    loaders.append_table(second.drop("revenue"), "conversions", where)
    assert sorted((r.conversion_id, r.revenue) for r in loaders.read_table(spark, where, "conversions").collect()) == \
        [(1, Decimal("1.00")), (2, Decimal("0.00"))]
    with pytest.raises(AnalysisException):
        loaders.refresh_table(second, "conversions", where)
    loaders.refresh_table(second, "conversions", str(tmp_path / "v2"))
    assert loaders.read_table(spark, str(tmp_path / "v2"), "conversions").count() == 1


def test_hot_missing_parent_is_no_hot_task(spark):
    n = 30_000
    child = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.lit(-7)).when(F.col("id") % 50 == 1, None)
                                  .otherwise(F.col("id") % 900).alias("k"))
    parent = spark.range(890).select(F.col("id").alias("p"))
    want = child.join(parent, F.col("k") == F.col("p"), "left_anti").filter("k IS NOT NULL")
    got = audits.fk_violations(child, "k", parent, "p")
    assert got.columns == child.columns and got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    # dealt by (key, salt), the hot key's rows fill no task
    sizes = [r["count"] for r in audits.salted(child).repartition(16, "k", audits.SALT)
             .groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2.5 * n / 16
    plain = [r["count"] for r in child.repartition(16, "k").groupBy(F.spark_partition_id()).count().collect()]
    assert max(plain) > n / 3


def test_distinct_ids_roll_up(spark):
    df = spark.range(5000).select((F.col("id") % 4).alias("d"), (F.col("id") % 3).alias("c"),
                                  F.when(F.col("id") % 11 != 0, (F.col("id") % 700) * 977 - 40_000).alias("u"))
    maps = distincts.id_bitmaps(df, ["d", "c"], "u")
    for keys in (["d", "c"], ["d"], ["c"], []):
        want = df.groupBy(*keys).agg(F.countDistinct("u").alias("n"))
        got = distincts.distinct_ids(maps, keys, "n")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert distincts.distinct_ids(distincts.id_bitmaps(df.limit(0), ["d"], "u"), [], "n").collect()[0]["n"] == 0


# Order of the reports: columns and whether they fall, as the warehouse sorts them.
ORDERS = {
    "campaign_performance": [("revenue", -1), ("sessions", -1)], "campaign_day_performance": [("campaign_id", 1), ("date", 1)],
    "q01_traffic": [("sessions", -1)], "q02_conversions_revenue": [("revenue", -1), ("conversions", -1)],
    "q03_kpi_snapshot": [("ROAS", -1), ("revenue", -1), ("sessions", -1)], "q05_conversion_mix": [("conversions", -1), ("revenue", -1)],
    "q06_new_vs_returning": [("session_date", 1)], "q07_top_revenue_day": [("revenue", -1)], "q08_campaign_totals": [("total_revenue", -1)],
    "q09_trend_from_view": [("activity_date", 1)], "q10_landing_page_kpis": [("campaign_id", 1)], "q11_device_kpis": [("campaign_id", 1)],
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_report_order(spark, name):
    rows = catalog()[name](spark, SF_SMALL).collect()

    def place(r):
        return tuple(sign * (v.toordinal() if hasattr(v, "toordinal") else v) for v, sign in ((r[c], s) for c, s in ORDERS[name]))

    places = [place(r) for r in rows]
    assert len(rows) > 1 and places == sorted(places)
