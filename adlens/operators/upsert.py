"""Batch upsert of daily costs: new table, audit log and rejected rows.

The warehouse upserts one (date, campaign, cost) at a time and throws on a bad
argument. Here a whole feed is applied at once:

* every feed row is checked in the warehouse's order - missing date (50030),
  missing campaign (50031), missing cost (50032), negative cost (50033),
  unknown campaign (50034); the first failing check is the row's reason and
  the row goes to ``rejects`` instead of aborting the batch;
* valid feed rows that share a key make the batch ambiguous (a MERGE would
  refuse it): they are returned as ``conflicts`` and no row of such a key is applied. Writing a
  batch with conflicts raises :class:`UpsertConflict` before anything is changed;
* valid rows update the matching (cost_date, campaign_id) row or are inserted;
  untouched target rows are kept and not logged; an update is logged even
  when the value does not change.

One frame, ``tagged_upsert``, evaluates a feed: every feed row and every target row of
the feed's days once, with what becomes of it. Nothing runs when it is defined.
``apply_upsert`` writes that frame to a staging folder, once, and from there
replaces only the days of the feed in a target stored by day: partitions of
other days keep their files. ``upsert_costs_daily`` gives the same outputs as
frames, the whole new table included.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlens.sources.schema import COSTS_DAILY, MONEY_SUM_DDL as MONEY

KEY = ["cost_date", "campaign_id"]

# Reject reasons, in check order (fixed values of the warehouse).
REJECT_REASONS = [
    (50030, "Cost date is required"),
    (50031, "Campaign id is required"),
    (50032, "Cost cannot be NULL"),
    (50033, "Cost cannot be negative"),
    (50034, "Campaign does not exist"),
]


KEEP, UPDATE, INSERT, REJECT, CONFLICT = "KEEP", "UPDATE", "INSERT", "REJECT", "CONFLICT"


class UpsertConflict(ValueError):
    """The feed holds more than one valid row for a key."""


@dataclass
class UpsertResult:
    table: DataFrame
    audit: DataFrame
    rejects: DataFrame
    conflicts: DataFrame


def classify_feed(feed: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Feed rows with ``error_code`` / ``error_message`` (NULL for valid rows)."""
    known = campaigns.select("campaign_id", F.lit(True).alias("_known"))
    j = feed.join(known, "campaign_id", "left")
    checks = [
        F.col("cost_date").isNull(),
        F.col("campaign_id").isNull(),
        F.col("cost").isNull(),
        F.col("cost") < 0,
        F.col("_known").isNull(),
    ]
    code = msg = None
    for cond, (num, text) in zip(checks, REJECT_REASONS):
        code = F.when(cond, F.lit(num)) if code is None else code.when(cond, F.lit(num))
        msg = F.when(cond, F.lit(text)) if msg is None else msg.when(cond, F.lit(text))
    return j.select("cost_date", "campaign_id", "cost",
                    code.alias("error_code"), msg.alias("error_message"))


def feed_rejects(feed: DataFrame, campaigns: DataFrame) -> DataFrame:
    return classify_feed(feed, campaigns).filter(F.col("error_code").isNotNull())


def tagged_upsert(target: DataFrame, feed: DataFrame, campaigns: DataFrame) -> DataFrame:
    """``feed`` applied to ``target`` as one frame: (action, cost_date, campaign_id, cost,
    old_cost, error_code, error_message, n).

    Feed rows come as UPDATE, INSERT, REJECT or CONFLICT, target rows without an
    applied feed row as KEEP. The feed is read and classified once: equal rows are counted (``n``),
    map-side first, a window finds the keys with several valid rows, and one full join meets the
    target. Only an applied row can meet a target row: the others have a
    ``_slot`` of their own, which also spreads rows without a key."""
    rows = classify_feed(feed, campaigns).withColumn("cost", F.col("cost").cast(MONEY))
    counted = rows.groupBy(*KEY, "cost", "error_code", "error_message").agg(F.count(F.lit(1)).alias("n"))
    valid = F.col("error_code").isNull()
    placed = counted.select(
        "*", F.coalesce("cost_date", F.lit("1970-01-01").cast("date")).alias("_d"), F.coalesce("campaign_id", F.lit(0)).alias("_c"),
        F.when(valid, F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("cost", "error_code"), F.lit(1024))).cast("int").alias("_slot"))
    of_key = F.sum("n").over(Window.partitionBy("_d", "_c", "_slot"))
    status = placed.select("*", F.when(~valid, F.lit(REJECT)).when(of_key > 1, F.lit(CONFLICT)).alias("_out"))
    status = status.withColumn("_slot", F.when(F.col("_out") == CONFLICT, -1).otherwise(F.col("_slot")))
    t = target.select(F.col("cost_date").alias("_d"), F.col("campaign_id").alias("_c"), F.lit(0).alias("_slot"),
                      F.col("cost").cast(MONEY).alias("old_cost"), F.lit(True).alias("_old"))
    m = t.join(status, ["_d", "_c", "_slot"], "full_outer")
    fed = F.col("n").isNotNull()
    key = {c: F.when(fed, F.col(c)).otherwise(F.col(k)).alias(c) for c, k in zip(KEY, ("_d", "_c"), strict=True)}
    return m.select(
        F.coalesce("_out", F.when(~fed, F.lit(KEEP)).when(F.col("_old"), F.lit(UPDATE)).otherwise(F.lit(INSERT))).alias("action"),
        *key.values(), F.when(fed, F.col("cost")).otherwise(F.col("old_cost")).alias("cost"), "old_cost", "error_code",
        "error_message", "n")


def _outputs(tagged: DataFrame) -> UpsertResult:
    action = F.col("action")
    table = tagged.filter(action.isin(KEEP, UPDATE, INSERT)).select(
        *[F.col(f.name).cast(f.dataType.simpleString()).alias(f.name) for f in COSTS_DAILY.fields])
    old = lambda c: F.when(action == UPDATE, F.col(c))
    audit = tagged.filter(action.isin(UPDATE, INSERT)).select(
        action.alias("action_taken"), F.col("cost_date").alias("new_cost_date"), old("cost_date").alias("old_cost_date"),
        F.col("campaign_id").alias("new_campaign_id"), old("campaign_id").alias("old_campaign_id"),
        F.col("cost").alias("new_cost"), old("old_cost").alias("old_cost"), F.localtimestamp().alias("timestamp"))
    rejects = tagged.filter(action == REJECT).select(*KEY, "cost", "error_code", "error_message",
                                                     F.explode(F.sequence(F.lit(1), F.col("n"))).alias("_i")).drop("_i")
    conflicts = tagged.filter(action == CONFLICT).select(*KEY, "cost", F.col("n").alias("rows"))
    return UpsertResult(table=table, audit=audit, rejects=rejects, conflicts=conflicts)


def upsert_costs_daily(target: DataFrame, feed: DataFrame, campaigns: DataFrame) -> UpsertResult:
    """The four outputs as frames over the whole target; defining them runs no job."""
    return _outputs(tagged_upsert(target, feed, campaigns))


def _refuse(conflicts: DataFrame) -> None:
    first = conflicts.limit(1).collect()
    if first:
        raise UpsertConflict(f"feed has several rows for key {tuple(first[0][:2])}")


def write_upsert(result: UpsertResult, location: str) -> dict[str, str]:
    """Write the outputs under ``location`` (must be a new folder); conflicts are refused."""
    _refuse(result.conflicts)
    paths = {name: f"{location.rstrip('/')}/{name}" for name in ("costs_daily", "audit", "rejects")}
    result.table.write.mode("errorifexists").parquet(paths["costs_daily"])
    result.audit.write.mode("errorifexists").parquet(paths["audit"])
    result.rejects.write.mode("errorifexists").parquet(paths["rejects"])
    return paths


def store_costs(costs: DataFrame, location: str) -> None:
    """A daily cost table stored by day, as :func:`apply_upsert` takes it."""
    _by_day(costs).write.mode("errorifexists").partitionBy("cost_date").parquet(location)


def read_costs(spark: SparkSession, location: str) -> DataFrame:
    return spark.read.schema(COSTS_DAILY).parquet(location).select(*COSTS_DAILY.names)


def _by_day(costs: DataFrame) -> DataFrame:
    return costs.select(*COSTS_DAILY.names).hint("rebalance", "cost_date")


def apply_upsert(location: str, feed: DataFrame, campaigns: DataFrame, staging: str) -> UpsertResult:
    """Apply ``feed`` to the table stored by day at ``location``.

    1. The tagged frame over the feed and the target's rows of its days is written
       to ``staging`` (a new folder): the only evaluation of the feed, and the source of all outputs.
    2. A batch with conflicts is refused; nothing has changed.
    3. The feed's days are overwritten from staging (dynamic partition overwrite). Days
       without an applied row keep their files. A failed write is repeated from staging with
       :func:`replace_days`; its rows do not depend on the target any more.
    """
    spark = feed.sparkSession
    days = feed.select("cost_date").filter(F.col("cost_date").isNotNull()).distinct()
    # a semi-join on the partition column: Spark prunes the target's partitions at run time
    touched = read_costs(spark, location).join(days, "cost_date", "left_semi")
    tagged_upsert(touched, feed, campaigns).write.mode("errorifexists").parquet(staging)
    result = _outputs(spark.read.parquet(staging))
    _refuse(result.conflicts)
    replace_days(location, staging, spark)
    return result


def replace_days(location: str, staging: str, spark: SparkSession) -> None:
    """Step 3 of :func:`apply_upsert`; may be repeated."""
    tagged = spark.read.parquet(staging)
    changed = tagged.filter(F.col("action").isin(UPDATE, INSERT)).select("cost_date").distinct()
    rows = _outputs(tagged).table.join(changed, "cost_date", "left_semi")
    _by_day(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("cost_date").parquet(location)
