"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the session's ``spark.checkpoint.dir``.

    Where that is unset, a folder of our own serves a local master; on a cluster it would be another
    one on each machine, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"{tempfile.gettempdir()}/checkpoints"
    return f"{root.rstrip('/')}/tideweave/{name}-{uuid.uuid4().hex}"


def _file(spark: SparkSession, path: str):
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark._jsc.hadoopConfiguration()), file


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside delete their shuffle files when they end; else these stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def staged(df: DataFrame, name: str = "staged", **options: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: cuts its plan and lineage, and survives lost executors.

    The table goes when it is released, or when the session ends.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with freeing_shuffles(spark):
        df.write.options(**options).parquet(path)
    return opened(spark, path, df)


def opened(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A table written to ``path`` with the columns of ``like``; it goes when the session ends."""
    system, file = _file(spark, path)
    system.deleteOnExit(file)
    found = spark.read.schema(like.schema).parquet(path)
    found.staged_at = path
    return found


def release(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for table in tables:
        system, file = _file(table.sparkSession, table.staged_at)
        system.delete(file, True)


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` make a table beside ``path``, then give it that name; what was there goes last.

    If writing or renaming fails, ``path`` is as it was before.
    """
    mark = uuid.uuid4().hex
    system, target = _file(spark, path.rstrip("/"))
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{what}-{mark}") for what in ("new", "old"))
    try:
        write(new.toString())
        held = system.exists(target)
        if held and not system.rename(target, old):
            raise OSError(f"cannot move {path}")
        if not system.rename(new, target):
            if held:
                system.rename(old, target)
            raise OSError(f"cannot rename to {path}")
        system.delete(old, True)
    finally:
        system.delete(new, True)
