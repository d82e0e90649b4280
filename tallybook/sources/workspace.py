"""Shared scratch space for jobs that write and read back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tallybook.sources import files


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a local one is made only on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.gettempdir()


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark).rstrip('/')}/tallybook-{name}-{uuid.uuid4().hex}"


def materialized(rows: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: computed once, lineage cut."""
    path = fresh_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class Scratch:
    """Copies in the shared folder that are removed together."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def keep(self, rows: DataFrame, name: str) -> DataFrame:
        path = fresh_dir(self.spark, name)
        self.paths.append(path)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Copies that a job needs only while it runs; they are removed when it ends, also when it fails."""
    copies = Scratch(spark)
    try:
        yield copies
    finally:
        for path in copies.paths:
            files.remove(spark, path)
