"""Integrity audits: the warehouse's constraints as distributed checks.

Each ``*_violations`` function returns the offending rows; the ``audit_*``
summaries return one row per (table, constraint) with the number of
violations, so a clean load is "every count is 0" and a summary is never an
empty relation. NULL passes a CHECK, as in SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.sources import schema as S



SALT, SALTS = "_salt", 64


def _summary(rows: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


def _one(table: str, constraint: str, count_col) -> list:
    return [F.lit(table).alias("table_name"), F.lit(constraint).alias("constraint_name"),
            count_col.cast("long").alias("violations")]


def pk_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values that occur more than once (with their multiplicity)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


def fk_violations(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL ``col`` has no parent.

    Keys are reduced to distinct ones, map-side, before they meet the parents. The
    missing ones, few in a sound load, then find their rows: by broadcast where AQE measures them
    small, else by a join in which a key is dealt to ``SALTS`` tasks, so a missing key that
    a third of the rows hold is no hot task either."""
    missing = missing_keys(child, col, parent, parent_col)
    return salted(child.filter(F.col(col).isNotNull())).join(spread(missing), [col, SALT], "left_semi").select(*child.columns)


def missing_keys(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Distinct non-NULL values of ``child.col`` that are no ``parent.parent_col``."""
    keys = child.filter(F.col(col).isNotNull()).select(col).distinct()
    return keys.join(parent.select(F.col(parent_col).alias(col)), col, "left_anti")


def salted(rows: DataFrame) -> DataFrame:
    """Rows with a salt that depends on nothing but their content."""
    return rows.withColumn(SALT, F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))


def spread(keys: DataFrame) -> DataFrame:
    """Every key under each salt."""
    return keys.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(SALT))


def check_conditions() -> dict[str, list[tuple[str, object]]]:
    """CHECK constraints per table as (name, condition that must not be FALSE)."""
    return {
        "users": [("ck_registration_after_first_seen",
                   F.col("registration_date").isNull() | (F.col("registration_date") >= F.col("first_seen_date")))],
        "conversions": [("ck_conversion_type", F.col("conversion_type").isin(*S.CONVERSION_TYPES)),
                        ("ck_revenue_nonneg", F.col("revenue") >= 0)],
        "costs_daily": [("ck_cost_nonneg", F.col("cost") >= 0)],
    }


def audit_pk(tables: dict[str, DataFrame]) -> DataFrame:
    """Duplicate primary keys per table (rows beyond the first), plus the
    one-session-per-click rule on ``sessions.click_id``."""
    rows = []
    for name, key in S.PRIMARY_KEYS.items():
        if name not in tables:
            continue
        dup = pk_violations(tables[name], key)
        rows.append(dup.agg(*_one(name, "pk_" + "_".join(key), F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)))))
    if "sessions" in tables:
        dup = pk_violations(tables["sessions"].filter(F.col("click_id").isNotNull()), ["click_id"])
        rows.append(dup.agg(*_one("sessions", "uq_click_id", F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)))))
    return _summary(rows)


def fk_violation_count(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Number of child rows without a parent, as a one-row frame ``n``.

    Child keys are counted first (map-side), so a key held by a third of the
    child rows reaches the anti-join as one row per task, not as a hot
    partition."""
    keys = child.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    p = parent.select(F.col(parent_col).alias(col))
    return keys.join(p, col, "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))


def audit_fk(tables: dict[str, DataFrame]) -> DataFrame:
    rows = []
    for child, col, parent, pcol in S.FOREIGN_KEYS:
        if child in tables and parent in tables:
            n = fk_violation_count(tables[child], col, tables[parent], pcol)
            rows.append(n.select(*_one(child, f"fk_{col}_{parent}", F.col("n"))))
    return _summary(rows)


def _per_table(table: str, counts: DataFrame, names: list[str]) -> DataFrame:
    """One aggregated row of counts -> one row per constraint (unpivot), so a
    table is scanned once however many constraints it has."""
    long = counts.unpivot([], names, "constraint_name", "violations")
    return long.select(F.lit(table).alias("table_name"), "constraint_name",
                       F.col("violations").cast("long").alias("violations"))


def audit_check(tables: dict[str, DataFrame]) -> DataFrame:
    """One pass per table: every CHECK counted in the same aggregation."""
    rows = []
    for name, checks in check_conditions().items():
        if name not in tables:
            continue
        counts = tables[name].agg(*[F.count(F.when(~F.coalesce(cond, F.lit(True)), 1)).alias(c)
                                    for c, cond in checks])
        rows.append(_per_table(name, counts, [c for c, _ in checks]))
    return _summary(rows)


def audit_not_null(tables: dict[str, DataFrame]) -> DataFrame:
    """NOT NULL columns: one conditional-count pass per table."""
    rows = []
    for name in S.TABLES:
        if name not in tables:
            continue
        cols = S.not_null_columns(name)
        counts = tables[name].agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"nn_{c}") for c in cols])
        rows.append(_per_table(name, counts, [f"nn_{c}" for c in cols]))
    return _summary(rows)


def orphan_clicks(clicks: DataFrame, sessions: DataFrame) -> DataFrame:
    """Clicks no session refers to, counted per campaign."""
    linked = sessions.filter(F.col("click_id").isNotNull()).select("click_id")
    return (clicks.join(linked, "click_id", "left_anti")
            .groupBy("campaign_id").agg(F.count(F.lit(1)).alias("orphan_clicks")))


def sessions_outside_day_view(clicks: DataFrame, sessions: DataFrame) -> DataFrame:
    """Session campaign-days with no click that day: the sessions the
    click-driven daily view leaves out."""
    s = sessions.groupBy("campaign_id", F.col("session_datetime").cast("date").alias("activity_date")) \
                .agg(F.count(F.lit(1)).alias("sessions"))
    c = clicks.select("campaign_id", F.col("click_datetime").cast("date").alias("activity_date")).distinct()
    return s.join(c, ["campaign_id", "activity_date"], "left_anti")
