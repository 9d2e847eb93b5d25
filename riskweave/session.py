"""Session helpers: a local session for tests and benches, and the shared work folder.

Jobs that write intermediate tables (layout rewrites, stream sinks, the daily
chain) put them under the folder the cluster names in ``spark.checkpoint.dir``.
Only when that is unset (local tests) is a private folder created and
registered as the checkpoint dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "riskweave") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("RISKWEAVE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide work folder (``spark.checkpoint.dir``).

    A private temporary folder is created only for a ``local[...]`` master
    (tests); on a cluster an unset ``spark.checkpoint.dir`` is an error, since a
    machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (HDFS, S3, ABFS)")
        conf = tempfile.mkdtemp(prefix="riskweave-ckpt-")
    sc.setCheckpointDir(conf)
    return (sc.getCheckpointDir() or conf).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared work folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for as long as a job runs."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def frees_shuffles(job: Callable) -> Callable:
    """For a job of several writes (``spark`` is its first argument): the shuffle files of each execution go as it ends.
    Otherwise they lie on the executors' disks until the driver happens to collect its garbage, those of all steps at
    once. An execution that needs a shuffle again makes it again."""

    @wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        with setting(spark, FREE_SHUFFLES, "true"):
            return job(spark, *args, **kwargs)

    return run


SCAN_BYTES = "spark.sql.files.maxPartitionBytes"


@contextmanager
def small_scans(spark: SparkSession, most: int) -> Iterator[None]:
    """Scans take at most so many bytes of files a task (or what the session says, if less)."""
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(SCAN_BYTES))
    with setting(spark, SCAN_BYTES, str(min(most, now))):
        yield
