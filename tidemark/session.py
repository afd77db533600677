"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when that costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task that writes by table keeps a file open for each, instead of sorting all its rows by table first.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings; safe to call on a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "tidemark") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, a local session (a laptop, a test) gets a temporary folder, which its only machine can reach;
    any other session is refused, as its executors would write to disks of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"spark.checkpoint.dir has to name a folder that all executors of {master or 'the cluster'} share")
    return _local_dir()


@cache
def _local_dir() -> str:
    """Made once per process and removed when it ends."""
    path = tempfile.mkdtemp(prefix="tidemark-shared-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder below the shared folder, whatever file system it is on."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
