"""Session helpers: build a local session for tests/bench, find the shared
checkpoint folder of whatever session the caller hands us, bound what a scan
task reads."""

from __future__ import annotations

import os
import re
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "indtables") -> SparkSession:
    """A session for tests and the bench. Library code never builds its own
    session; it takes the caller's."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("INDTABLES_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, stream checkpoints and
    scratch output: the one the session names in ``spark.checkpoint.dir`` (or
    an earlier ``setCheckpointDir``). Where neither is set, a session in
    ``local`` mode gets a scratch folder of its own; on a cluster that would
    be one machine's disk, so the missing setting is an error there."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if not configured and sc is not None:
        configured = sc.getCheckpointDir()
    if not configured:
        if sc is None or not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="indtables-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, on whatever filesystem it names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


@contextmanager
def scan_splits(spark: SparkSession, most: int):
    """Scans planned inside give a task at most ``most`` bytes of files, or what the
    session allows where that is less. For jobs that hold a task's whole split (a
    sort before the shuffle); the session's own setting is back afterwards."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(most, spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)
