"""Readers that tolerate a table that is not there yet."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_table(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """Current content of a table root.

    With a schema, ``date=`` directories get its type and columns that old files lack read
    as NULL. Without one the footers are merged, which costs a pass over all of them.
    """
    if schema is None:
        return spark.read.option("mergeSchema", "true").parquet(path)
    return spark.read.schema(schema).parquet(path)


def find_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The table, or None where there is none yet; its files are listed once.

    For a table that ``rewrite_table`` replaces, call ``settle_table`` before.
    """
    try:
        return read_table(spark, path, schema)
    except AnalysisException as error:
        if is_missing_path(error):
            return None
        raise


def table_exists(spark: SparkSession, path: str, schema: StructType) -> bool:
    return find_table(spark, path, schema) is not None


def read_table_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    table = find_table(spark, path, schema)
    return empty_table(spark, schema) if table is None else table


def with_declared(rows: DataFrame, schema: StructType) -> DataFrame:
    """Declared columns first, with their types and NULL where missing, then all others."""
    declared = [
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    others = [c for c in rows.columns if c not in schema.fieldNames()]
    return rows.select(*declared, *others)


def find_stored(
    spark: SparkSession, path: str, schema: StructType, base: str | None = None
) -> DataFrame | None:
    """What is stored under ``path``, with columns the schema does not know; None if nothing.

    For rows that are written back: a column added by an earlier upsert must not get lost.
    """
    reader = spark.read.option("mergeSchema", "true")
    if base is not None:
        reader = reader.option("basePath", base)
    try:
        return with_declared(reader.parquet(path), schema)
    except AnalysisException as error:
        # Without any file there are no columns to infer.
        if is_missing_path(error) or error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def find_partitions(
    spark: SparkSession, path: str, schema: StructType, days: Sequence[object], partition: str
) -> DataFrame | None:
    """Stored rows of the given partitions; no other directory is listed or opened."""
    names = ",".join("__HIVE_DEFAULT_PARTITION__" if d is None else str(d) for d in days)
    return find_stored(spark, f"{path}/{partition}={{{names}}}", schema, base=path)


def read_days(
    spark: SparkSession, path: str, schema: StructType, days: Sequence[dt.date], partition: str = "date"
) -> DataFrame:
    """Rows of the given days; only their directories are listed, and no footer is read to plan the scan."""
    names = ",".join(d.isoformat() for d in days)
    reader = spark.read.schema(schema).option("basePath", path)
    try:
        return reader.parquet(f"{path}/{partition}={{{names}}}") if days else empty_table(spark, schema)
    except AnalysisException as error:
        if is_missing_path(error):
            return empty_table(spark, schema)
        raise
