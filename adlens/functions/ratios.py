"""Exact KPI ratio expressions.

Every KPI is ``numerator / denominator`` rounded half away from zero to two
decimals (the inputs are never negative, so half-up). Division is done in
DECIMAL with 18-digit operands, so it is exact where a DECIMAL(10,2)-operand
formula would be and cannot overflow at warehouse scale; Spark 4 runs in ANSI
mode, so a zero denominator is turned into NULL before dividing.

Two zero policies exist and both are needed:

* ``ratio``       - NULL when the denominator is 0 (daily view, query pack)
* ``ratio_or_0``  - 0.00 when the denominator is 0 (range reports, snapshots)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlens.sources.schema import RATIO_DDL as RATIO

OPERAND = "decimal(18,2)"
# Numerator type of the weighted cohort ratios (5 decimals) and an integer
# denominator, as in the cohort rollups.
COHORT_NUMERATOR = "decimal(18,5)"
COUNT_DECIMAL = "decimal(18,0)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(num, den) -> Column:
    """``round_half_up(num / den, 2)`` as DECIMAL; NULL when ``den`` is 0 or NULL."""
    n = _c(num).cast(OPERAND)
    d = F.nullif(_c(den).cast(OPERAND), F.lit(0).cast(OPERAND))
    return (n / d).cast(RATIO)


def ratio_or_0(num, den) -> Column:
    """As :func:`ratio` but 0.00 instead of NULL for a zero denominator."""
    return F.coalesce(ratio(num, den), F.lit(0).cast(RATIO))


def _cohort_quotient(num, den) -> Column:
    n = _c(num).cast(COHORT_NUMERATOR)
    d = F.nullif(_c(den).cast(COUNT_DECIMAL), F.lit(0).cast(COUNT_DECIMAL))
    return n / d


def cohort_ratio(num, den) -> Column:
    """Weighted conversion rate of a cohort rollup, NULL on an empty cohort."""
    return _cohort_quotient(num, den).cast(RATIO)


def cohort_lift(num_hi, num_lo, den) -> Column:
    """``num_hi/den - num_lo/den`` from the unrounded quotients, then rounded.

    This is not the difference of two rounded rates: 1/3 -> 2/3 gives 0.33 here,
    whereas 0.67 - 0.33 = 0.34 (see :func:`rate_difference`).
    """
    return (_cohort_quotient(num_hi, den) - _cohort_quotient(num_lo, den)).cast(RATIO)


def rate_difference(rate_hi, rate_lo) -> Column:
    """Difference of two already-rounded rates (per-cohort-day lift)."""
    return (_c(rate_hi) - _c(rate_lo)).cast(RATIO)


def zero_if_null(x, dtype=None) -> Column:
    """``ISNULL(x, 0)`` keeping the column's type (or casting to ``dtype``)."""
    col = _c(x) if dtype is None else _c(x).cast(dtype)
    zero = F.lit(0) if dtype is None else F.lit(0).cast(dtype)
    return F.coalesce(col, zero)
