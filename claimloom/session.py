"""Session settings and the shared folder that written intermediate tables go to."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any
from uuid import uuid4
from weakref import WeakKeyDictionary

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}

# The folder of each frame that cut_lineage returned and that is still in use.
_WRITTEN: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()

# Runtime re-planning carries the skew handling of every large equi join: a hot key's
# partition is split over several tasks instead of being left to one.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where a later operator would have reused its partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows placed by a part of a join's keys need not move again for the whole key.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}

# Only settable when a session starts. Plans are built from many small expressions; recording a
# call site for each costs more than planning them.
STARTUP_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

# Files of the warehouse and its source: keys and amounts, which the default codec hardly shortens.
CODEC = "zstd"


def build_session(app_name: str = "claimloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings this library is designed for. Sizes stay with the caller."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **STARTUP_SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else started."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session may go without one; it gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="claimloom-")
    return _LOCAL_DIRS[context.applicationId]


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read back, so that nothing before runs again."""
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/claimloom-{uuid4().hex[:12]}"
    df.write.parquet(folder)
    rows = spark.read.schema(df.schema).parquet(folder)
    _WRITTEN[rows] = folder
    return rows


def _opened(spark: SparkSession, path: str):
    """A path and the file system it lies in."""
    context = spark.sparkContext
    opened = context._jvm.org.apache.hadoop.fs.Path(path)
    return opened, opened.getFileSystem(context._jsc.hadoopConfiguration())


def release(*written: DataFrame) -> None:
    """Delete the folders that ``cut_lineage`` wrote for these rows; nothing may read them any more."""
    for rows in written:
        path, system = _opened(rows.sparkSession, _WRITTEN.pop(rows))
        system.delete(path, True)


def files_under(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of the files that a pattern names, in whatever store it lies."""
    path, system = _opened(spark, pattern)
    return [status.getPath().toString() for status in system.globStatus(path) or []]


def together(spark: SparkSession, *jobs: Callable[[], Any]) -> list[Any]:
    """Run independent writes at the same time, so that small ones do not leave the cluster idle.

    The first error is raised after all of them have ended.
    """
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [future.result() for future in futures]
