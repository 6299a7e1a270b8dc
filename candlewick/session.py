"""Spark session settings the library relies on.

The library never creates a cluster session on its own behalf; ``get_session``
is for tests, the bench and scripts.  ``checkpoint_root`` is where stored tables
and streaming checkpoints go: the shared folder the cluster names in
``spark.checkpoint.dir``.  Only when that is unset (local runs, tests) do we pick
one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every query assumes: UTC wall clock (the warehouse's DateTime columns
# and the JSON epoch milliseconds are both UTC), AQE for runtime re-planning of
# joins (broadcast only when the measured side is small, skew splitting).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.driver.memory": "8g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(master: str | None = None, app_name: str = "candlewick", **extra: str) -> SparkSession:
    """Builder for local runs; on a cluster pass the cluster's own session instead."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**LOCAL_CONF, **REQUIRED_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the queries need to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    checkpoint_root(spark)
    return spark


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Settings for the start of a query; the session's own come back afterwards.

    A streaming query reads its settings when it plans its first batch, and keeps them in
    its checkpoint.
    """
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local session without the setting gets a private temporary folder;
    a cluster session without it is an error.
    """
    sc = spark.sparkContext
    root = (spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
            or sc.getCheckpointDir())
    if not root:
        if not sc.master.startswith("local"):
            # A machine-local folder would scatter files over the executors' disks.
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (e.g. on HDFS or S3)")
        root = tempfile.mkdtemp(prefix="candlewick-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh sub-folder of the checkpoint root (for stream sinks and checkpoints)."""
    return "/".join([checkpoint_root(spark), *parts, uuid.uuid4().hex])


def scale_conf(input_bytes: int, total_cores: int, target_task_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` on ``total_cores`` executor cores.

    Scan splits and post-shuffle partitions aim at ``target_task_bytes`` each (a
    task's working set stays well inside executor memory, spills stay rare), with
    at least two tasks per core.  AQE merges partitions that turn out smaller
    and splits skewed join partitions above twice the target.  Streaming state
    goes to RocksDB.  Example: 100 TB
    on 8,000 cores gives about 400k shuffle partitions of ~256 MB before AQE
    coalescing.
    """
    shuffle_parts = max(2 * total_cores, -(-int(input_bytes) // target_task_bytes))
    return {
        # Streaming state off the JVM heap with incremental (changelog) commits;
        # fixed per checkpoint, so it must be set before a query first starts.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.files.maxPartitionBytes": str(target_task_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_task_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_task_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }
