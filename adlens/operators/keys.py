"""Surrogate keys: dense, gap-free 1-based numbers in a business order.

A warehouse IDENTITY column numbers rows as they are loaded. The distributed
equivalent must not funnel the table through one task (a global
``ROW_NUMBER() OVER (ORDER BY ...)`` does), so it reuses the sliced running
count of :mod:`adlens.operators.sequence` with a single constant key: slices
are counted locally and shifted by the row counts of the earlier slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.operators.sequence import sequence_number

_ALL = "_key_all"


def surrogate_keys(df: DataFrame, order: Sequence[str], out: str = "surrogate_key",
                   start: int = 1) -> DataFrame:
    """Add ``out``: ``start``, ``start + 1``, ... following ``order`` (which
    must be a total order: end it with a unique column)."""
    keyed = sequence_number(df.withColumn(_ALL, F.lit(0)), _ALL, order, out)
    cols = [c for c in df.columns]
    return keyed.select(*cols, (F.col(out) + F.lit(start - 1)).alias(out))
