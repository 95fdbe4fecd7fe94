"""Written tables that cut lineage and fix results that must not be recomputed."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths given out within ``passing``, by thread.
_paths: dict[int, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the session names; a temporary one only in local mode."""
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):  # not local-cluster
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gleanery-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in this application's scratch folder, which goes when the session ends."""
    folder = f"{scratch_root(spark)}/gleanery/{spark.sparkContext.applicationId}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(target)
    files.deleteOnExit(target)  # takes only what exists
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    if (within := _paths.get(threading.get_ident())) is not None:
        within.append(path)
    return path


def discard(spark: SparkSession, *paths: str) -> None:
    """Deletes scratch tables that nothing will read again."""
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Scratch paths given out within go at its end, and shuffles with the query that made them; what is evaluated later must be stored below a path from outside."""
    thread, paths = threading.get_ident(), []
    before, _paths[thread] = _paths.get(thread), paths
    try:
        with _setting(spark, _SHUFFLES_GO, True):
            yield
    finally:
        if before is None:
            del _paths[thread]
        else:
            _paths[thread] = before
        discard(spark, *paths)


@contextmanager
def _setting(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def small_batches(spark: SparkSession, most: int = 4 << 20) -> Iterator[None]:
    """Within, tasks hand rows to Python in batches of some *most* bytes, however long rows are; for what is evaluated within."""
    with _setting(spark, _BATCH_BYTES, most):
        yield


def written(rows: DataFrame, name: str, path: str | None = None, compact: bool = False) -> DataFrame:
    """*rows* written once as parquet and read back.

    *compact* is for little data out of many tasks: it is gathered into few
    files, instead of one tiny file per task.
    """
    spark = rows.sparkSession
    path = path or scratch_path(spark, name)
    (rows.hint("rebalance") if compact else rows).write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
