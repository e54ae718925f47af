"""Exact half-up KPI rounding, both zero policies, lift, and overflow safety."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adlens.functions.ratios import cohort_lift, cohort_ratio, rate_difference, ratio, ratio_or_0


@pytest.mark.parametrize("n,d,expected", [
    (1, 8, "0.13"),      # 0.125 - a tie, rounds up
    (29, 200, "0.15"),   # 0.145 - a tie that DOUBLE division gets wrong
    (23, 40, "0.58"),    # 0.575
    (10, 16, "0.63"),    # 0.625
    (5, 16, "0.31"),
    (0, 7, "0.00"),
])
def test_ratio_half_up(spark, n, d, expected):
    row = spark.range(1).select(ratio(F.lit(n), F.lit(d)).alias("r")).first()
    assert row.r == Decimal(expected)


def test_zero_policies(spark):
    row = spark.range(1).select(ratio(F.lit(3), F.lit(0)).alias("a"),
                                ratio_or_0(F.lit(3), F.lit(0)).alias("b"),
                                ratio(F.lit(3), F.lit(None)).alias("c")).first()
    assert row.a is None and row.b == Decimal("0.00") and row.c is None


def test_money_ratio(spark):
    row = spark.range(1).select(
        ratio(F.lit(Decimal("50.00")), F.lit(Decimal("15.00"))).alias("r")).first()
    assert row.r == Decimal("3.33")


def test_large_counts_do_not_overflow(spark):
    # DECIMAL(10,2) would overflow at 10^8; ANSI mode would raise.
    row = spark.range(1).select(
        ratio(F.lit(100_000_000_000), F.lit(3)).alias("a"),
        ratio(F.lit(100_000), F.lit(100_000_000)).alias("b"),
        cohort_ratio(F.lit(100_000), F.lit(300_000)).alias("c")).first()
    assert row.a == Decimal("33333333333.33")
    assert row.b == Decimal("0.00")
    assert row.c == Decimal("0.33")


def test_lift_unrounded_vs_rounded(spark):
    # 3 sessions: 1 converted by D0, 2 by D7.
    row = spark.range(1).select(
        cohort_lift(F.lit(2), F.lit(1), F.lit(3)).alias("rollup_lift"),
        rate_difference(cohort_ratio(F.lit(2), F.lit(3)), cohort_ratio(F.lit(1), F.lit(3))).alias("day_lift"),
    ).first()
    assert row.rollup_lift == Decimal("0.33")
    assert row.day_lift == Decimal("0.34")


def test_cohort_ratio_empty_is_null(spark):
    assert spark.range(1).select(cohort_ratio(F.lit(0), F.lit(0)).alias("r")).first().r is None
