"""The campaign model as stored, typed parquet tables.

``load_model(spark, sf_dir)`` returns the six model tables (and the upsert
feed). The first call for a given input folder derives them from the driver
tables and writes them, with their declared schemas, under the session's
checkpoint folder; later calls - in this or any session pointing at the same
shared folder - read the written tables. Reading stored tables is what a
warehouse query does: filters and column pruning reach the parquet scan, and
the lineage of the derivation (several shuffles deep) is cut.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.session import checkpoint_root
from adlens.sources import schema as S
from adlens.sources.testdata import derive_model

# Bump when the mapping in ``testdata`` changes: stored tables of an older
# mapping are then ignored.
MODEL_VERSION = "7"
# Driver tables that the model is derived from.
INPUT_TABLES = ("events", "nation", "region", "customer")
MODEL_TABLES = ("campaigns", "users", "clicks", "sessions", "conversions", "costs_daily", "cost_feed")
_SCHEMAS = dict(S.TABLES, cost_feed=S.COST_FEED)
# Upper bound on rows per written file (a few GB of narrow rows): large slices
# are split into several files instead of one huge one.
MAX_RECORDS_PER_FILE = 50_000_000
# Days (range reports prune to their partitions) and, inside them, time order.
_TIMES = {"clicks": "click_datetime", "sessions": "session_datetime", "conversions": "conversion_datetime"}
# Buckets of clicks and sessions: one for so many bytes of events, within bounds (see ``bucket_count``).
BUCKET_BYTES = 64 << 20
LEAST_BUCKETS, MAX_BUCKETS = 16, 1024


@dataclass
class Model:
    campaigns: DataFrame
    users: DataFrame
    clicks: DataFrame
    sessions: DataFrame
    conversions: DataFrame
    costs_daily: DataFrame
    cost_feed: DataFrame
    location: str | None = None
    reused: bool = False

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def register(self, prefix: str = "") -> None:
        """Expose the tables as temp views (``campaigns``, ``sessions``, ...)."""
        for name in MODEL_TABLES:
            self.table(name).createOrReplaceTempView(prefix + name)


_CACHE: dict[tuple, Model] = {}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project and cast ``df`` to the declared schema of ``table``."""
    sch = _SCHEMAS[table]
    return df.select(*[F.col(f.name).cast(f.dataType.simpleString()).alias(f.name) for f in sch.fields])


def with_day(df: DataFrame, table: str) -> DataFrame:
    """A declared table with the day that it is stored under. Clicks and sessions have it in their
    time; conversions bring their session's (see :func:`conversions_by_day`)."""
    day = S.DAY_COLUMNS.get(table)
    if day is None:
        return conform(df, table)
    own = F.col(day) if day in df.columns else F.col(_TIMES[table]).cast("date")
    return df.select(*[F.col(f.name).cast(f.dataType.simpleString()).alias(f.name) for f in _SCHEMAS[table].fields], own.alias(day))


def conversions_by_day(conversions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Conversions with their session's day, for loads that bring none (NULL: no such session).
    Sessions are unique by id; the conversions of a hot session are split by AQE's skew join."""
    days = sessions.select("session_id", F.col("session_datetime").cast("date").alias("session_day"))
    return conversions.join(days, "session_id", "left")


def _store(spark: SparkSession, df: DataFrame, name: str, location: str, buckets: int) -> None:
    """Write one table. Days are rebalanced (a large one is split over tasks, small ones share files); a
    bucketed table is dealt by its unique key, a file for each day and bucket."""
    day, key = S.DAY_COLUMNS.get(name), S.BUCKET_KEYS.get(name)
    df = with_day(df, name)
    if key and buckets:
        df = df.repartition(buckets, key).sortWithinPartitions(day, _TIMES[name])
        df.write.partitionBy(day).bucketBy(buckets, key).mode("errorifexists").option("path", f"{location}/{name}") \
            .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).saveAsTable(_table_name(location, name))
        return
    if day:
        df = df.hint("rebalance", day).sortWithinPartitions(day, _TIMES[name])
    writer = df.write.mode("errorifexists").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    (writer.partitionBy(day) if day else writer).parquet(f"{location}/{name}")


def _table_name(location: str, name: str) -> str:
    """Bucketing is known to Spark's catalog only, so bucketed tables have an entry there."""
    return f"adlens_{name}_{hashlib.sha1(location.encode()).hexdigest()[:12]}"


@contextmanager
def _days_found_by_folder(spark: SparkSession) -> Iterator[None]:
    """Tables entered meanwhile find their days in their folder, not one by one in the catalog."""
    key = "spark.sql.hive.manageFilesourcePartitions"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def _bucketed(spark: SparkSession, name: str, location: str, buckets: int) -> DataFrame:
    """The bucketed table, entered in this session's catalog where it isn't yet."""
    table, day = _table_name(location, name), S.DAY_COLUMNS[name]
    if not spark.catalog.tableExists(table):
        cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _SCHEMAS[name].fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}, {day} date) USING parquet PARTITIONED BY ({day}) "
                  f"CLUSTERED BY ({S.BUCKET_KEYS[name]}) INTO {buckets} BUCKETS LOCATION '{location}/{name}'")
    return spark.table(table)


def bucket_count(spark: SparkSession, volume: int) -> int:
    """Buckets for ``volume`` bytes of events. As many as shuffle partitions, so that a shuffled side joins a
    bucketed one as it is, but no more than the bytes are worth: every day has a file for each bucket, and
    writing and listing tens of thousands of tiny files costs far more than the exchange that they save."""
    worth = max(LEAST_BUCKETS, -(-volume // BUCKET_BYTES))
    return min(MAX_BUCKETS, worth, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _code_fingerprint() -> str:
    """Hash of the code that decides the stored tables' content, so a stored
    model from other mapping code is never picked up."""
    from adlens.operators import sequence
    from adlens.sources import testdata
    h = hashlib.sha1()
    for mod in (testdata, sequence, S):
        with open(mod.__file__, "rb") as f:
            h.update(f.read())
    return h.hexdigest()[:12]


def input_stamp(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """(stamp, bytes of events): the stamp covers path, length and modification time of every input file,
    by the file system that holds them: a replaced or rewritten input has another one."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    seen, volume = [], 0
    for name in INPUT_TABLES:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            continue
        files = fs.listFiles(path, True)
        while files.hasNext():
            f = files.next()
            seen.append(f"{f.getPath()}|{f.getLen()}|{f.getModificationTime()}")
            volume += f.getLen() if name == "events" else 0
    return hashlib.sha1("\n".join(sorted(seen)).encode()).hexdigest()[:16], volume


def _model_key(sf_dir: str, stamp: str) -> str:
    where = os.path.abspath(sf_dir) if "://" not in sf_dir else sf_dir.rstrip("/")
    raw = f"{where}|{stamp}|v{MODEL_VERSION}|{_code_fingerprint()}"
    return hashlib.sha1(raw.encode()).hexdigest()[:16]


def _try_read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        df = spark.read.parquet(path)
        df.schema  # noqa: B018 - forces the footer read / path check
        return df
    except AnalysisException:
        return None


def _find_complete(spark: SparkSession, base: str) -> str | None:
    """A previously written model folder is complete when its manifest exists."""
    manifest = _try_read(spark, f"{base}/_manifest")
    if manifest is None:
        return None
    rows = manifest.orderBy("written_by").limit(1).collect()  # one row per finished writer
    return rows[0]["location"] if rows else None


def _read_stored(spark: SparkSession, location: str, buckets: int) -> Model:
    tables = {}
    for name in MODEL_TABLES:
        if buckets and name in S.BUCKET_KEYS:
            tables[name] = _bucketed(spark, name, location, buckets)
            continue
        sch = T.StructType([*_SCHEMAS[name].fields, *([T.StructField(S.DAY_COLUMNS[name], T.DateType())] if name in S.DAY_COLUMNS else [])])
        tables[name] = spark.read.schema(sch).parquet(f"{location}/{name}")
    return Model(location=location, **tables)


def build_model(spark: SparkSession, sf_dir: str) -> Model:
    """Lazy, unstored model (used by tests that compare against stored output)."""
    derived = derive_model(spark, sf_dir)
    return Model(**{name: conform(derived[name], name) for name in MODEL_TABLES})


def load_model(spark: SparkSession, sf_dir: str, store: bool = True, buckets: int | None = None) -> Model:
    """The stored model of an input folder, written on the first call. ``buckets``: of clicks and
    sessions (default :func:`bucket_count`; 0: none)."""
    stamp, volume = input_stamp(spark, sf_dir)
    buckets = bucket_count(spark, volume) if buckets is None else buckets
    key = (spark.sparkContext.applicationId, sf_dir, stamp, store, buckets)
    if key in _CACHE:
        return _CACHE[key]
    if not store:
        model = build_model(spark, sf_dir)
        _CACHE[key] = model
        return model
    base = f"{checkpoint_root(spark)}/adlens_model/{_model_key(sf_dir, stamp)}-{buckets}"
    location = _find_complete(spark, base)
    reused = location is not None
    if location is None:
        # Each writer uses its own folder, so concurrent builders never
        # overwrite each other; the manifest row is written last.
        location = f"{base}/{uuid.uuid4().hex}"

        def keep(df: DataFrame) -> DataFrame:
            """The counted events, written once: four frames start from them."""
            df.write.parquet(f"{location}/_events")
            return spark.read.schema(df.schema).parquet(f"{location}/_events")

        derived = derive_model(spark, sf_dir, keep)
        # The seven writes are independent jobs; submitted together they share
        # the executors instead of queueing one after another.
        with _days_found_by_folder(spark), ThreadPoolExecutor(max_workers=len(MODEL_TABLES)) as pool:
            for f in [pool.submit(_store, spark, derived[name], name, location, buckets) for name in MODEL_TABLES]:
                f.result()
        spark.createDataFrame([(location, location.rsplit("/", 1)[-1])], "location string, written_by string") \
            .coalesce(1).write.mode("append").parquet(f"{base}/_manifest")
    with _days_found_by_folder(spark):
        model = _read_stored(spark, location, buckets)
    model.reused = reused
    _CACHE[key] = model
    return model
