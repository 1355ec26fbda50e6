"""Session helpers.

Library code never sets cluster settings itself; it only reads
``spark.checkpoint.dir``, and sets what ``settings`` puts back. ``build_session`` is for tests, the bench and
local runs: it turns AQE (with skew-join splitting) on and, only when no
checkpoint folder is configured and the master is local, points
checkpointing at a fresh scratch folder.
"""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "rewardflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and job outputs.

    Taken from the session (``spark.checkpoint.dir``). Only a local-mode
    session with nothing configured gets a fresh scratch folder, removed when
    the driver ends; a cluster session without the setting is an error, because a machine-local folder
    does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    path = tempfile.mkdtemp(prefix="rewardflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


#: shuffle files of a query go when it ends, not when the driver's JVM next collects garbage
LET_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold within the block; afterwards they are as before."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def settle(spark: SparkSession, pause: float = 0.25) -> None:
    """Let Spark's cleaner remove shuffle files of plans that are done. What Python lets go
    reaches the JVM through a thread of its own, and the cleaner is one too: without the
    pauses the files of the last plan would stay until the next call."""
    for _ in range(2):
        gc.collect()
        time.sleep(pause)
        spark._jvm.System.gc()
        time.sleep(pause)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
