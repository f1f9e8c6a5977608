"""Folders of any file system that Spark reaches, from the driver: listing, moving, removing."""

import os

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(name, time of the last change in milliseconds) of what a folder holds; none if it is absent."""
    path = _path(spark, folder)
    system = _system(spark, path)
    if not system.exists(path):
        return []
    return [(s.getPath().getName(), s.getModificationTime()) for s in system.listStatus(path)]


def exists(spark: SparkSession, folder: str) -> bool:
    path = _path(spark, folder)
    return _system(spark, path).exists(path)


def remove(spark: SparkSession, folder: str) -> None:
    path = _path(spark, folder)
    _system(spark, path).delete(path, True)


def move_if_absent(spark: SparkSession, source: str, target: str) -> bool:
    """Give a folder that holds files another name in one step, unless there is one of that name.

    Of several that try at the same time, one succeeds. That holds for local and mounted folders and for
    file systems whose rename is one step and doesn't overwrite (HDFS; not for plain object stores).
    """
    old, new = _path(spark, source), _path(spark, target)
    system = _system(spark, new)
    system.mkdirs(new.getParent())
    if system.getUri().getScheme() == "file":
        try:
            os.rename(old.toUri().getPath(), new.toUri().getPath())
        except OSError:
            if system.exists(new):
                return False
            raise
        return True
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        new.toUri(), spark._jsc.hadoopConfiguration()
    )
    no_options = spark._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(old, new, no_options)
    except Exception:
        if system.exists(new):
            return False
        raise
    return True
