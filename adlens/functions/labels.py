"""Text labels compared without regard to case or trailing blanks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_key(col: str | Column) -> Column:
    """Equal for labels that differ in case or trailing blanks only."""
    return F.lower(F.rtrim(F.col(col) if isinstance(col, str) else col))


def one_spelling(grouped: DataFrame, keys: list[str], label: str, measures: list[Column]) -> DataFrame:
    """Fold rows already grouped by ``keys`` and the raw ``label`` into one row
    per label whatever its spelling; the least spelling names it. ``measures``
    add up the groups. The raw rows keep their hash aggregation by the stored
    text; only the grouped rows, few a key, are grouped again."""
    folded = grouped.groupBy(*keys, label_key(label).alias("_label")).agg(F.min(label).alias(label), *measures)
    return folded.drop("_label")
