"""Exact distinct counts that roll up: mergeable bitmaps of integer ids.

``COUNT(DISTINCT user_id)`` by day can't be added up to weeks or over campaigns, so
each grain would read the raw rows again. Here the ids of a group are bitmaps (one for each 32,768
consecutive ids that occur), built map-side; any coarser grain is their union. Ids should
be dense, as surrogate keys are: a bitmap takes 4 KB however few of its ids occur.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_bitmaps(df: DataFrame, keys: Sequence, id_: str) -> DataFrame:
    """(keys, bucket, ids): the ids of each group. NULL ids count nowhere, as in COUNT(DISTINCT)."""
    known = df.filter(F.col(id_).isNotNull())
    # Distinct first: a hot id, or a hot group of few ids, is a row a task before the bitmaps are built.
    rows = known.select(*keys, F.col(id_).cast("long").alias("_id")).distinct()
    names = [c for c in rows.columns if c != "_id"]
    return rows.groupBy(*names, F.bitmap_bucket_number("_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("ids"))


def distinct_ids(bitmaps: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Exact distinct ids by any of the bitmaps' keys (none: overall)."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
    return merged.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("ids")), F.lit(0)).cast("long").alias(out))
