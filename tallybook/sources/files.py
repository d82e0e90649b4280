"""Folders of a file system that Spark can reach: whether they are there, renamed, removed, listed by partition."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _folder(spark, path)
    return system.exists(place)


def written(spark: SparkSession, path: str) -> bool:
    """Whether a write of Spark's into this folder was finished."""
    return exists(spark, f"{path}/_SUCCESS")


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds; nothing happens if it is not there."""
    system, place = _folder(spark, path)
    system.delete(place, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    system, place = _folder(spark, path)
    if not system.rename(place, _folder(spark, to)[1]):
        raise OSError(f"cannot rename {path} to {to}")


def partition_days(spark: SparkSession, path: str, partition: str = "date") -> list[dt.date]:
    """Days that have a partition below ``path``, in order; one folder each, so the calendar bounds them."""
    system, place = _folder(spark, path)
    if not system.exists(place):
        return []
    names = [status.getPath().getName() for status in system.listStatus(place)]
    days = [name.removeprefix(f"{partition}=") for name in names if name.startswith(f"{partition}=")]
    return sorted(dt.date.fromisoformat(d) for d in days if not d.startswith("__"))
