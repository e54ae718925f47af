"""Date helpers: calendar day of a timestamp, inclusive ranges, date series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def day_of(ts) -> Column:
    """Calendar day of a TIMESTAMP_NTZ column (``CAST(ts AS DATE)``)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return c.cast("date")


def as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def check_range(start, end, missing_code: int, order_code: int) -> tuple[dt.date, dt.date]:
    """Validate report arguments; raises ``ReportArgumentError`` with the code."""
    if start is None or end is None:
        raise ReportArgumentError(missing_code, "start_date and end_date are required")
    s, e = as_date(start), as_date(end)
    if s > e:
        raise ReportArgumentError(order_code, "start_date cannot be after end_date")
    return s, e


def date_bounds(start, end, missing_code: int) -> tuple[dt.date, dt.date]:
    """Both dates are needed; a reversed range is allowed and holds no day."""
    if start is None or end is None:
        raise ReportArgumentError(missing_code, "start_date and end_date are required")
    return as_date(start), as_date(end)


def in_range(col, start: dt.date, end: dt.date) -> Column:
    """Inclusive ``BETWEEN start AND end`` on a DATE column."""
    c = F.col(col) if isinstance(col, str) else col
    return c.between(F.lit(start), F.lit(end))


def on_days(df: DataFrame, day: str, start: dt.date, end: dt.date) -> DataFrame:
    """Rows of a stored table whose partition column ``day`` lies in the range (a frame
    without that column passes whole: the caller's own filter decides)."""
    return df.filter(in_range(day, start, end)) if day in df.columns else df


def date_series(spark: SparkSession, start: dt.date, end: dt.date, name: str = "date") -> DataFrame:
    """One row per calendar day in ``[start, end]``.

    Built as a single generated array; its size is the number of days in the
    range (a report parameter), never a function of the data.
    """
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))).alias(name)
    )


class ReportArgumentError(ValueError):
    """Bad report arguments; ``code`` carries the warehouse error number."""

    def __init__(self, code: int, message: str):
        super().__init__(f"{code}: {message}")
        self.code = code


def activity_calendar(df: DataFrame, ts_col: str, name: str = "date") -> DataFrame:
    """Every calendar day from the first to the last day of ``ts_col`` in
    ``df`` (days without rows included). One aggregation finds the bounds; the
    days are generated from that single row, nothing goes through the driver."""
    bounds = df.agg(F.min(day_of(ts_col)).alias("_lo"), F.max(day_of(ts_col)).alias("_hi"))
    return bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias(name))
