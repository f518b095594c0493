"""Folder operations on whatever file system a path belongs to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _locate(spark, path)
    return system.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible entries of a folder."""
    system, target = _locate(spark, path)
    if not system.exists(target):
        return []
    names = [item.getPath().getName() for item in system.listStatus(target)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def data_files(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Name and path of the data files of a table: the file itself, or the visible files of the folder and those below it."""
    system, target = _locate(spark, path)
    if not system.exists(target):
        return []
    names, waiting = [], [system.getFileStatus(target)]
    while waiting:
        item = waiting.pop()
        name = item.getPath().getName()
        if item.isFile():
            names.append((name, item.getPath().toString()))
            continue
        waiting += [c for c in system.listStatus(item.getPath()) if not c.getPath().getName().startswith(("_", "."))]
    return sorted(names)


def make_folder(spark: SparkSession, path: str) -> None:
    system, target = _locate(spark, path)
    system.mkdirs(target)


def remove(spark: SparkSession, path: str) -> bool:
    system, target = _locate(spark, path)
    return system.delete(target, True)
