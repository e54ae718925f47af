"""Typed schemas of the campaign model.

Money is DECIMAL(10,2) per row; event-scale keys are BIGINT, campaign keys INT;
event times are TIMESTAMP_NTZ (second precision is a property of the data, the
type does not truncate).
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
# Sums of money: wide enough for any realistic total; the oracle uses the same.
MONEY_SUM = T.DecimalType(18, 2)
# Final type of every KPI ratio: two decimals like the warehouse's
# DECIMAL(10,2), widened so a large ratio cannot overflow (ANSI mode raises).
RATIO = T.DecimalType(18, 2)
# The same types as SQL type strings. Casting to a string type is one JVM call;
# casting to a DataType object also serialises and parses the type, which
# multiplies the cost of building a plan with hundreds of casts.
MONEY_DDL = MONEY.simpleString()
MONEY_SUM_DDL = MONEY_SUM.simpleString()
RATIO_DDL = RATIO.simpleString()

CAMPAIGNS = T.StructType([
    T.StructField("campaign_id", T.IntegerType(), False),
    T.StructField("campaign_name", T.StringType(), False),
    T.StructField("channel", T.StringType(), False),
    T.StructField("start_date", T.DateType(), True),
])

USERS = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("first_seen_date", T.DateType(), False),
    T.StructField("registration_date", T.DateType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("gender", T.StringType(), True),
])

CLICKS = T.StructType([
    T.StructField("click_id", T.LongType(), False),
    T.StructField("campaign_id", T.IntegerType(), False),
    T.StructField("click_datetime", T.TimestampNTZType(), False),
    T.StructField("cost", MONEY, True),
])

SESSIONS = T.StructType([
    T.StructField("session_id", T.LongType(), False),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("campaign_id", T.IntegerType(), False),
    T.StructField("click_id", T.LongType(), True),
    T.StructField("device", T.StringType(), False),
    T.StructField("landing_page", T.StringType(), True),
    T.StructField("session_datetime", T.TimestampNTZType(), False),
])

CONVERSIONS = T.StructType([
    T.StructField("conversion_id", T.LongType(), False),
    T.StructField("session_id", T.LongType(), False),
    T.StructField("conversion_datetime", T.TimestampNTZType(), False),
    T.StructField("conversion_type", T.StringType(), False),
    T.StructField("revenue", MONEY, False),
])

COSTS_DAILY = T.StructType([
    T.StructField("cost_date", T.DateType(), False),
    T.StructField("campaign_id", T.IntegerType(), False),
    T.StructField("cost", MONEY_SUM, False),  # a day's sum outgrows a single click's type
])

# Input of the batch upsert: every field may be missing, bad rows are rejected.
COST_FEED = T.StructType([
    T.StructField("cost_date", T.DateType(), True),
    T.StructField("campaign_id", T.IntegerType(), True),
    T.StructField("cost", MONEY_SUM, True),
])

TABLES = {
    "campaigns": CAMPAIGNS,
    "users": USERS,
    "clicks": CLICKS,
    "sessions": SESSIONS,
    "conversions": CONVERSIONS,
    "costs_daily": COSTS_DAILY,
}

PRIMARY_KEYS = {
    "campaigns": ["campaign_id"],
    "users": ["user_id"],
    "clicks": ["click_id"],
    "sessions": ["session_id"],
    "conversions": ["conversion_id"],
    "costs_daily": ["cost_date", "campaign_id"],
}

# Stored fact tables are partitioned by day; a conversion is stored under its *session's* day, the day
# that reports count it on. The column is part of the stored table, not of the declared model.
DAY_COLUMNS = {"clicks": "click_day", "sessions": "session_day", "conversions": "session_day"}
# Unique keys that large stored tables are bucketed on, so that joins on them need no exchange of
# their rows. (Conversions are not: a session may hold many; they are summed map-side instead.)
BUCKET_KEYS = {"clicks": "click_id", "sessions": "session_id"}


def declared(df, table: str):
    """The declared columns of a stored table, without its day."""
    return df.select(*[f.name for f in TABLES[table].fields])


# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("sessions", "user_id", "users", "user_id"),
    ("sessions", "campaign_id", "campaigns", "campaign_id"),
    ("sessions", "click_id", "clicks", "click_id"),
    ("clicks", "campaign_id", "campaigns", "campaign_id"),
    ("conversions", "session_id", "sessions", "session_id"),
    ("costs_daily", "campaign_id", "campaigns", "campaign_id"),
]

# Fixed values of the model (must equal the warehouse definition).
CONVERSION_TYPES = ("Lead", "Registration", "Purchase")
DEFAULT_DEVICE = "Unknown"
ORPHAN_LABEL = "Orphan clicks (no session)"


def not_null_columns(table: str) -> list[str]:
    return [f.name for f in TABLES[table].fields if not f.nullable]
