"""Session helpers: reliable checkpoints and schema contracts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A folder set on the context counts too. Only a one-process local master may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a shared folder")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="epipanel-"))
    return context.getCheckpointDir()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def temporary(spark: SparkSession, name: str) -> str:
    """A new shared folder that goes when the session's JVM ends: results that are still read lie there."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(target)
    files.deleteOnExit(target)
    return path


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A shared folder for what is needed inside a ``with`` block only, deleted behind it."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        remove(spark, path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written or collected in a ``with`` block go as each job ends, not when the driver collects its garbage."""
    before = spark.conf.get(CLEANUP_KEY, None)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_KEY)
        else:
            spark.conf.set(CLEANUP_KEY, before)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Schema contract: raise before a plan is built if columns are missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df
