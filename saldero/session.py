"""Session settings and scratch space."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(cores: str = "*", shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("saldero")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # call-site capture for every column expression doubles planning time
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the session names for intermediate tables.

    Only a local session without one gets a folder of its own, because a
    machine-local path means nothing to the executors of a cluster.
    """
    named = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder all executors share")
    own = tempfile.mkdtemp(prefix="saldero-")
    spark.sparkContext.setCheckpointDir(own)
    return shared_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let ``DataFrame.checkpoint`` write below the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever it lies; a missing one is fine."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextlib.contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A fresh path below the shared folder for the time of one job."""
    path = scratch_path(spark, purpose)
    try:
        yield path
    finally:
        remove_path(spark, path)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder, removed when the session's JVM ends."""
    path = f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    file_system.mkdirs(hadoop_path)
    file_system.deleteOnExit(hadoop_path)
    return path
