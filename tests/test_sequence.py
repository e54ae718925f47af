"""The hot-key-safe running count must equal ROW_NUMBER, whatever the skew."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from adlens.operators.keys import surrogate_keys
from adlens.operators.sequence import order_slices, running_sums, sequence_number


def _skewed(spark, n=6000):
    # user 7 holds a third of all rows; timestamps repeat so the id breaks ties.
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 97).alias("user_id"),
        (F.col("id") % 50).alias("t"),
        F.col("id").alias("event_id"),
        (F.col("id") % 2).cast("int").alias("flag"),
    )


def test_sequence_matches_row_number_with_hot_key(spark):
    df = _skewed(spark)
    got = sequence_number(df, "user_id", ["t", "event_id"], "seq")
    w = Window.partitionBy("user_id").orderBy("t", "event_id")
    want = df.withColumn("seq", F.row_number().over(w))
    diff = got.select("event_id", "seq").exceptAll(want.select("event_id", "seq"))
    assert got.count() == df.count()
    assert diff.count() == 0


def test_hot_key_is_split_across_slices(spark):
    """The windows' partitions are (key, slice): the hot user's largest one is a small share of the rows."""
    df = _skewed(spark, 30000)
    fine = order_slices(df, "t")[0]
    sizes = [r["count"] for r in df.groupBy("user_id", fine.alias("s")).count().filter("user_id = 7").collect()]
    assert len(sizes) == 50 and max(sizes) <= 1.1 * 30000 / 3 / 50


def test_rows_cross_one_exchange_and_no_job_runs(spark):
    """Only the slices' sums are shuffled beside the rows; defining the frame runs nothing."""
    sc = spark.sparkContext
    df = spark.range(5000).select((F.col("id") % 7).alias("u"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"),
                                  F.col("id").alias("e"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("payload"))
    sc.setJobGroup("define", "define")
    got = sequence_number(df, "u", ["ts", "e"], "seq")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not sc.statusTracker().getJobIdsForGroup("define")
    sc.setJobGroup("rest", "rest")
    raw = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert len(raw) >= 3 and "checkpoint" not in plan.lower()
    carrying = [k for k, line in enumerate(plan.split("\n")) if "Exchange hashpartitioning" in line
                and "payload" in plan.split("\n")[k + 1]]
    assert len(carrying) == 1


@pytest.mark.parametrize("kind, values", [
    ("date", "date_add(DATE'2024-01-01', CAST(id % 90 AS INT))"),
    ("string", "CONCAT('k', CAST(id % 800 AS STRING), 'xyzxyz')"),
    ("long", "id * 1000003 - 5000000"),
    ("nulls", "IF(id % 4 = 0, NULL, id % 13)"),
    ("time before 1970", "TIMESTAMP_NTZ'1969-12-31 22:00:00' + make_dt_interval(0, 0, 0, id)"),
])
def test_slices_of_every_order_type(spark, kind, values):
    df = spark.range(4000).select((F.col("id") % 5).alias("u"), F.expr(values).alias("o"), F.col("id").alias("e"))
    got = sequence_number(df, "u", ["o", "e"], "seq")
    want = df.withColumn("seq", F.row_number().over(Window.partitionBy("u").orderBy("o", "e")))
    assert got.exceptAll(want).count() == 0 and got.count() == 4000


def test_running_sum_of_flags(spark):
    df = _skewed(spark, 3000)
    got = running_sums(df, "user_id", ["t", "event_id"], {"n_flag": "flag", "n_all": None})
    w = Window.partitionBy("user_id").orderBy("t", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("event_id", F.sum("flag").over(w).alias("n_flag"), F.count(F.lit(1)).over(w).alias("n_all"))
    assert got.select("event_id", "n_flag", "n_all").exceptAll(want).count() == 0


def test_surrogate_keys_dense(spark):
    df = spark.range(2500).select((F.col("id") * 7 % 2500).alias("x"))
    got = surrogate_keys(df, ["x"], "k")
    rows = got.agg(F.min("k"), F.max("k"), F.countDistinct("k"), F.sum(F.col("k") - F.col("x"))).first()
    assert tuple(rows) == (1, 2500, 2500, 2500)  # k = x + 1 for every row


def test_null_keys_form_one_group(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 11).cast("long").alias("user_id"),
        F.col("id").alias("event_id"))
    got = sequence_number(df, "user_id", ["event_id"], "seq")
    w = Window.partitionBy("user_id").orderBy("event_id")
    want = df.withColumn("seq", F.row_number().over(w))
    assert got.select("event_id", "seq").exceptAll(want.select("event_id", "seq")).count() == 0
    assert got.filter(F.col("user_id").isNull()).agg(F.max("seq")).first()[0] == 3000


def test_empty_input_and_more_slices_than_rows(spark):
    empty = spark.createDataFrame([], "user_id long, event_id long")
    assert sequence_number(empty, "user_id", ["event_id"], "seq").count() == 0
    tiny = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "user_id long, event_id long")
    got = sorted((r.event_id, r.seq) for r in sequence_number(tiny, "user_id", ["event_id"], "seq").collect())
    assert got == [(10, 1), (11, 2), (12, 1)]
