"""SparkSession construction and the shared materialisation folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session settings every entry point relies on. Timestamps in the model are
# TIMESTAMP_NTZ, so the zone only matters for display; UTC keeps it stable.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # PySpark 4 records the Python call site of every Column operation for
    # error messages (a stack walk plus JVM calls each time). Plans here are
    # built from hundreds of expressions, so the capture costs more than the
    # query on small inputs; batch jobs do not need it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Delete checkpoint files once nothing references them (the per-key
    # sequence writes one per call).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


MAX_SHUFFLE_PARTITIONS = 16_384


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "adlens", extra: dict | None = None) -> SparkSession:
    """Get or create a session with the library defaults (tests, bench, CLI).

    ``master`` is left to spark-submit / spark-defaults unless given (the
    launcher falls back to local mode when nothing names one).
    ``shuffle_partitions=None`` keeps the configured value; tests and the bench
    pass their own (see :func:`cluster_conf` for a cluster).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    This is whatever ``spark.checkpoint.dir`` names (on a cluster: a shared file
    system), or the parent of a checkpoint folder set with ``setCheckpointDir``.
    Only a local-mode session with neither gets a scratch folder; a cluster
    session with neither is refused instead of being handed a machine-local path.
    """
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # setCheckpointDir() adds a per-application sub-folder; share the parent.
        return current.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...): "
                           "checkpoints and written intermediate tables go there")
    # Local session without a checkpoint folder: one scratch root per user, so
    # separate local processes over the same input share the stored model.
    local = os.path.join(tempfile.gettempdir(), f"adlens-local-{os.getuid()}")
    os.makedirs(local, exist_ok=True)
    sc.setCheckpointDir(local)
    return local


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Suggested settings for a run over ``input_bytes`` of model tables.

    Shuffle partitions (also the slice count of the hot-key-safe sequence) hold
    about ``target_partition_bytes`` each, but there are at most
    ``MAX_SHUFFLE_PARTITIONS``: maps times reduces is block metadata in the
    driver, and most shuffles carry aggregated rows far smaller than the input.
    AQE merges small ones and splits skewed joins. Pass the result to the session
    builder; ``spark.checkpoint.dir`` must name a shared folder.
    """
    parts = min(MAX_SHUFFLE_PARTITIONS, max(8, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
