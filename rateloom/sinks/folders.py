"""Folders of whatever file system a path names, seen from the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _target(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _target(spark, path)
    return files.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    files, target = _target(spark, path)
    files.delete(target, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if it is missing."""
    files, target = _target(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


def finished(spark: SparkSession, path: str) -> list[str]:
    """Names of the tables in a folder whose job has ended well."""
    return [name for name in children(spark, path) if exists(spark, f"{path}/{name}/_SUCCESS")]
