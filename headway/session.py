"""Session helpers for tests and the bench (library code never sets conf)."""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import time
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "headway") -> SparkSession:
    """A local session pinned to UTC, AQE on, UI off."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .getOrCreate()
    )


_SCRATCH: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables: ``spark.checkpoint.dir``.

    Where the session has none, a scratch folder is taken on a ``local[...]``
    master only (one machine, as in tests).  On a cluster the setting is
    required: a machine-local folder would be another one on each executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # A core setting can't be changed in a running session; the folder is kept
        # by the application that it was made for.
        app = spark.sparkContext.applicationId
        root = _SCRATCH.get(app) or _SCRATCH.setdefault(app, tempfile.mkdtemp(prefix="headway-ckpt-"))
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    return os.path.join(checkpoint_root(spark), *parts)


def hadoop_fs(spark: SparkSession, path: str):
    """(file system, path object) of a path, by Spark's own configuration."""
    obj = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return obj.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), obj


_RUN = uuid.uuid4().hex[:12]


def run_folder(spark: SparkSession) -> str:
    """The folder of this run's staged tables.  It goes when the run's JVM ends
    (by Hadoop's delete-on-exit), however long that takes; no other run's age
    rule touches it.  What a killed driver leaves is for ``expire_runs``."""
    path = scratch_path(spark, "headway-staging", f"{spark.sparkContext.applicationId}-{_RUN}")
    fs, obj = hadoop_fs(spark, path)
    if not fs.exists(obj):
        fs.mkdirs(obj)
        fs.deleteOnExit(obj)
    return path


_SCOPE: contextvars.ContextVar[str] = contextvars.ContextVar("headway_staging_scope", default="")


def staging_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for a staged table of this run."""
    return f"{run_folder(spark)}/{_SCOPE.get()}{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def staging_scope(spark: SparkSession, name: str):
    """What is staged in the ``with`` block (of this thread) is deleted at its end:
    for steps whose result is written elsewhere before."""
    scope = f"{_SCOPE.get()}{name}-{uuid.uuid4().hex}/"
    token = _SCOPE.set(scope)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        fs, obj = hadoop_fs(spark, f"{run_folder(spark)}/{scope}")
        fs.delete(obj, True)


def expire_runs(spark: SparkSession, hours: float) -> list[str]:
    """Delete the folders of other runs that staged nothing for ``hours``; only
    to be called with more hours than any run can take.  Returns their names."""
    own = run_folder(spark)
    fs, obj = hadoop_fs(spark, os.path.dirname(own))
    gone = []
    for run in fs.listStatus(obj):
        name = run.getPath().getName()
        last = max([run.getModificationTime(), *(s.getModificationTime() for s in fs.listStatus(run.getPath()))])
        if name != os.path.basename(own) and last < (time.time() - hours * 3600) * 1000:
            fs.delete(run.getPath(), True)
            gone.append(name)
    return gone
