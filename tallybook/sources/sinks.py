"""Table writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallybook.sources import files


def _by_partition(rows: DataFrame, partition: str) -> DataFrame:
    # Rebalancing gathers a day's rows into few files, yet AQE still splits a day that is
    # far larger than the others; a plain repartition would send it to a single task.
    return rows.hint("rebalance", partition)


def write_partitioned(rows: DataFrame, path: str, partition: str = "date") -> None:
    """Create (or fully replace) a partitioned table."""
    (
        _by_partition(rows, partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(partition)
        .parquet(path)
    )


def overwrite_partitions(rows: DataFrame, path: str, partition: str = "date") -> None:
    """Replace only the partitions that occur in ``rows``; it may be derived from ``path``."""
    (
        _by_partition(rows, partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def append_partitions(rows: DataFrame, path: str, partition: str = "date") -> None:
    """Add rows to partitions; what they hold stays."""
    _by_partition(rows, partition).write.mode("append").partitionBy(partition).parquet(path)


def write_table(rows: DataFrame, path: str) -> None:
    """Create (or fully replace) an unpartitioned table."""
    rows.hint("rebalance").write.mode("overwrite").parquet(path)


def _next(path: str) -> str:
    return f"{path.rstrip('/')}.next"


def _former(path: str) -> str:
    return f"{path.rstrip('/')}.former"


def rewrite_table(rows: DataFrame, path: str) -> None:
    """Replace an unpartitioned table with rows that were derived from it, so that it is never lost.

    The new table is written beside the old one and takes its place by two renames. Wherever this
    is cut off, ``settle_table`` brings back the old table or finishes the new one. Meant for small tables such
    as the rates; large ones are partitioned.
    """
    spark = rows.sparkSession
    settle_table(spark, path)
    write_table(rows, _next(path))
    if files.exists(spark, path):
        files.remove(spark, _former(path))
        files.rename(spark, path, _former(path))
    settle_table(spark, path)
    files.remove(spark, _former(path))


def settle_table(spark: SparkSession, path: str) -> None:
    """Put a table back whose replacement was cut off. Whoever reads such a table calls this first.

    If the old table was moved away, the new one was wholly written and takes its place. If not, the
    table is as it was; what was written beside it is overwritten by the next replacement.
    """
    if files.exists(spark, path):
        return
    if files.written(spark, _next(path)):
        files.rename(spark, _next(path), path)
    elif files.exists(spark, _former(path)):
        files.rename(spark, _former(path), path)
