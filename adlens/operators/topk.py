"""Top-k by a total order (``SELECT TOP (n) ... ORDER BY``).

``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: every task keeps its
own best ``n`` rows and only those reach the final merge, so the work is one
scan and the data moved is ``tasks x n`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_n(df: DataFrame, n: int, order: list[str | Column]) -> DataFrame:
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    return df.orderBy(*cols).limit(n)
