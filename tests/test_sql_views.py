"""The derived relations are usable from Spark SQL under their warehouse names."""

from __future__ import annotations

import shutil
from decimal import Decimal

from pyspark.sql import functions as F

from adlens.operators import insights
from adlens.plans.catalog import day_kpis, register_views
from adlens.session import MAX_SHUFFLE_PARTITIONS, cluster_conf, get_spark
from adlens.sources import model as M
from adlens.sources.model import load_model
from tests.conftest import SF_SMALL


def test_views_answer_sql(spark):
    register_views(spark, SF_SMALL)
    m = load_model(spark, SF_SMALL)
    busiest = spark.sql("SELECT max(sessions) AS most, count(DISTINCT campaign_id) AS n FROM vw_campaign_day_kpis").first()
    day = day_kpis(m)
    assert busiest["most"] == day.agg(F.max("sessions")).first()[0]
    assert busiest["n"] == insights.campaign_totals(day).count()
    cohorts = spark.sql("SELECT count(*) FROM vw_click_cohort_cvr_d0_d7_d30 WHERE cohort_date IS NOT NULL").first()[0]
    assert cohorts == spark.table("vw_click_cohort_cvr_d0_d7_d30").count() > 0


def test_cluster_conf_sizes_partitions():
    c = cluster_conf(100 << 40)          # 100 TiB
    assert int(c["spark.sql.shuffle.partitions"]) == MAX_SHUFFLE_PARTITIONS
    assert cluster_conf(10 << 40)["spark.sql.shuffle.partitions"] == str(MAX_SHUFFLE_PARTITIONS)
    assert cluster_conf(1 << 40)["spark.sql.shuffle.partitions"] == "4096"
    assert cluster_conf(1)["spark.sql.shuffle.partitions"] == "8"
    assert Decimal(c["spark.sql.files.maxPartitionBytes"]) == 256 << 20


def test_get_spark_keeps_the_configured_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert get_spark().conf.get("spark.sql.shuffle.partitions") == before


def test_model_follows_a_replaced_input(spark, tmp_path):
    """New content under the same path is never answered from the stored model."""
    folder = tmp_path / "data"
    folder.mkdir()
    for name in M.INPUT_TABLES:
        shutil.copyfile(f"{SF_SMALL}/{name}.parquet", folder / f"{name}.parquet")
    whole = load_model(spark, str(folder)).sessions.count()
    half = spark.read.parquet(f"{SF_SMALL}/events.parquet").toPandas().iloc[::2]
    half.to_parquet(folder / "events.parquet", index=False, coerce_timestamps="us")
    again = load_model(spark, str(folder))
    assert not again.reused and again.sessions.count() < whole
    M._CACHE.clear()                      # what a new session starts with
    stored = load_model(spark, str(folder))
    assert stored.reused and stored.sessions.count() == again.sessions.count()


def test_daily_cost_outgrows_one_click(spark, tmp_path):
    from adlens.sources.testdata import _daily_click_cost, cost_feed, events

    clicks = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-02 10:00:00' AS click_datetime, 1 AS campaign_id, "
                       "CAST(99999999.00 AS DECIMAL(10,2)) AS cost FROM range(3)")
    assert _daily_click_cost(clicks).first()["cost"] == Decimal("299999997.00")
    feed = cost_feed(clicks, events(spark, SF_SMALL)).filter("cost > 100000000").first()
    assert feed["cost"] == Decimal("299999998.00")
