"""Label normalisation, date helpers and argument checks."""

import datetime as dt

import pytest

from adlens.functions.dates import ReportArgumentError, as_date, check_range, date_series
from adlens.sources.loaders import normalise_label


def test_device_variants_group_together(spark):
    df = spark.createDataFrame([("Mobile",), ("mobile ",), (" MOBILE",), ("Desktop",)], "device string")
    got = {r.d: r["count"] for r in df.groupBy(normalise_label("device").alias("d")).count().collect()}
    assert got == {"Mobile": 3, "Desktop": 1}


def test_date_series_inclusive(spark):
    rows = [r.date for r in date_series(spark, dt.date(2024, 2, 27), dt.date(2024, 3, 2)).collect()]
    assert rows == [dt.date(2024, 2, 27), dt.date(2024, 2, 28), dt.date(2024, 2, 29),
                    dt.date(2024, 3, 1), dt.date(2024, 3, 2)]


def test_argument_forms_and_codes():
    assert as_date("2024-01-08") == as_date(dt.datetime(2024, 1, 8, 13, 0)) == dt.date(2024, 1, 8)
    assert check_range("2024-01-01", "2024-01-01", 1, 2) == (dt.date(2024, 1, 1), dt.date(2024, 1, 1))
    with pytest.raises(ReportArgumentError) as e:
        check_range(None, None, 50020, 50021)
    assert e.value.code == 50020


def test_cli_list_and_report(spark, capsys):
    from adlens.__main__ import main
    assert main(["list"]) == 0
    assert "campaign_performance" in capsys.readouterr().out.split()
    assert main(["report", "performance", "--data", "/root/testdata/sf0.001",
                 "--start", "2024-01-08", "--end", "2024-01-21", "--show", "3"]) == 0
    assert "campaign_name" in capsys.readouterr().out


def test_case_insensitive_collation_groups_variants(spark):
    from adlens.sources.loaders import case_insensitive
    df = spark.createDataFrame([("Mobile",), ("MOBILE",), ("Mobile ",), ("Desktop",)], "device string")
    groups = df.groupBy(case_insensitive("device").alias("d")).count().collect()
    assert sorted(r["count"] for r in groups) == [1, 3]


def test_cli_upsert_writes_new_folder(spark, capsys):
    import tempfile

    from adlens.__main__ import main
    out = tempfile.mkdtemp(prefix="adlens-cli-") + "/costs_v2"
    assert main(["upsert", "--data", "/root/testdata/sf0.001", "--out", out]) == 0
    assert spark.read.parquet(out + "/costs_daily").count() > 0
    assert {r.action_taken for r in spark.read.parquet(out + "/audit").collect()} == {"INSERT", "UPDATE"}


def test_cli_run_and_cohorts(spark, capsys):
    from adlens.__main__ import main
    assert main(["run", "q05_conversion_mix", "--data", "/root/testdata/sf0.001", "--show", "5"]) == 0
    assert "conversion_type" in capsys.readouterr().out
    assert main(["cohorts", "campaign-device", "--data", "/root/testdata/sf0.001",
                 "--start", "2024-01-01", "--end", "2024-01-28", "--show", "3"]) == 0
    assert "lift_0_to_7" in capsys.readouterr().out
