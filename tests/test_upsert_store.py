"""The upsert into a table stored by day: files of untouched days stay, one evaluation, nothing at definition."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adlens.operators import upsert
from adlens.plans.inspect import operators
from adlens.sources.model import load_model
from adlens.sources.schema import COST_FEED, COSTS_DAILY
from tests.conftest import SF_SMALL


def files(root):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(root) for n in names
            if n.endswith(".parquet")}


def day(n):
    return dt.date(2024, 1, n)


@pytest.fixture
def stored(spark, tmp_path):
    rows = [(day(n), c, Decimal(f"{n}.{c}0")) for n in range(1, 11) for c in (1, 2, 3)]
    where = str(tmp_path / "costs")
    upsert.store_costs(spark.createDataFrame(rows, COSTS_DAILY), where)
    campaigns = spark.createDataFrame([(1,), (2,), (3,), (4,)], "campaign_id int")
    return where, campaigns, {(d, c): v for d, c, v in rows}


def content(spark, where):
    return {(r.cost_date, r.campaign_id): r.cost for r in upsert.read_costs(spark, where).collect()}


def test_only_days_of_the_feed_are_replaced(spark, stored, tmp_path):
    where, campaigns, want = stored
    before = files(where)
    feed = [(day(2), 1, Decimal("9.00")), (day(2), 4, Decimal("8.00")), (day(20), 1, Decimal("7.00")), (day(5), 9, Decimal("1.00")),
            (None, 1, Decimal("1.00"))]
    got = upsert.apply_upsert(where, spark.createDataFrame(feed, COST_FEED), campaigns, str(tmp_path / "staging"))
    want |= {(day(2), 1): Decimal("9.00"), (day(2), 4): Decimal("8.00"), (day(20), 1): Decimal("7.00")}
    assert content(spark, where) == want
    assert sorted((r.action_taken, r.new_cost_date.day, r.old_cost) for r in got.audit.collect()) == \
        [("INSERT", 2, None), ("INSERT", 20, None), ("UPDATE", 2, Decimal("2.10"))]
    assert sorted(r.error_code for r in got.rejects.collect()) == [50030, 50034]
    after = files(where)
    # day 5 had a rejected row only: its files stay as well
    assert {f for f in before if "-02/" not in f} <= set(after)
    assert all(after[f] == t for f, t in before.items() if "-02/" not in f)
    assert not any(f in after for f in before if "-02/" in f)
    upsert.replace_days(where, str(tmp_path / "staging"), spark)    # repeated after a lost commit
    assert content(spark, where) == want


def test_conflicts_change_nothing(spark, stored, tmp_path):
    where, campaigns, want = stored
    before = files(where)
    feed = spark.createDataFrame([(day(2), 1, Decimal("9.00")), (day(3), 1, Decimal("1.00")), (day(3), 1, Decimal("1.00"))], COST_FEED)
    with pytest.raises(upsert.UpsertConflict):
        upsert.apply_upsert(where, feed, campaigns, str(tmp_path / "staging"))
    assert files(where) == before and content(spark, where) == want


def test_empty_feed_and_repeated_rejects(spark, stored, tmp_path):
    where, campaigns, want = stored
    before = files(where)
    upsert.apply_upsert(where, spark.createDataFrame([], COST_FEED), campaigns, str(tmp_path / "a"))
    assert files(where) == before
    bad = spark.createDataFrame([(None, 1, Decimal("1.00"))] * 3 + [(day(1), None, None)] * 2, COST_FEED)
    got = upsert.apply_upsert(where, bad, campaigns, str(tmp_path / "b"))
    assert sorted(r.error_code for r in got.rejects.collect()) == [50030] * 3 + [50031] * 2
    assert files(where) == before and content(spark, where) == want


def test_defining_the_upsert_runs_no_job_and_classifies_once(spark):
    m = load_model(spark, SF_SMALL)
    spark.sparkContext.setJobGroup("upsert", "upsert")
    tagged = upsert.tagged_upsert(m.costs_daily, m.cost_feed, m.campaigns)
    got = upsert.upsert_costs_daily(m.costs_daily, m.cost_feed, m.campaigns)
    assert got.audit.columns[0] == "action_taken"
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("upsert")
    spark.sparkContext.setJobGroup("rest", "rest")
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 3                                # target, feed, campaigns: each once
    assert operators(tagged).count("Window") == 1


def test_a_key_fed_without_end_meets_the_target_as_one_row(spark):
    target = spark.createDataFrame([(day(1), 1, Decimal("1.00"))], COSTS_DAILY)
    feed = spark.range(20_000).select(F.lit(day(1)).alias("cost_date"), F.lit(1).alias("campaign_id"),
                                      F.lit("2.00").cast("decimal(18,2)").alias("cost"))
    got = upsert.upsert_costs_daily(target, feed, spark.createDataFrame([(1,)], "campaign_id int"))
    assert [tuple(r) for r in got.conflicts.collect()] == [(day(1), 1, Decimal("2.00"), 20_000)]
    assert got.table.collect()[0]["cost"] == Decimal("1.00") and got.audit.count() == 0
