"""What is known of the raw files: read once per file, and remembered.

The raw directory is not partitioned. The manifest says which of its files hold a day, and what
columns they have, so that curating a day opens those files only, and no footer twice.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.schemas import TRANSACTIONS
from tallybook.sources.sinks import rewrite_table, settle_table
from tallybook.sources.tables import empty_table, is_missing_path, read_table_or_empty, with_declared

MANIFEST = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("schema", T.StringType()),
    T.StructField("first_day", T.DateType()),
    T.StructField("last_day", T.DateType()),
    T.StructField("rows", T.LongType()),
    T.StructField("undated", T.LongType()),
])
_TIME = "event_time"


def listed_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, modified, length`` of the Parquet files below a directory; none is opened."""
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return empty_table(spark, T.StructType(MANIFEST.fields[:3]))
    return found.select("path", F.col("modificationTime").alias("modified"), "length")


def _disagree(error: Exception) -> bool:
    """Whether files could not be read together since a column has different types; Spark wraps this in no error of its own."""
    return "CANNOT_MERGE_SCHEMAS" in str(error)


def file_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files with the schema they can be read with together. Columns of one type per name are merged, as one
    distributed pass over the footers does; only if two files disagree is each footer read by itself."""
    if not paths:
        return []
    try:
        return [(spark.read.option("mergeSchema", "true").parquet(*paths).schema, list(paths))]
    except (PySparkException, Py4JJavaError) as error:
        if not _disagree(error):
            raise
    with ThreadPoolExecutor(16) as pool:
        schemas = list(pool.map(lambda path: spark.read.parquet(path).schema, paths))
    groups: dict[tuple, tuple[T.StructType, list[str]]] = {}
    for path, schema in zip(paths, schemas, strict=True):
        kind = tuple(sorted((f.name, f.dataType.json()) for f in schema.fields))
        groups.setdefault(kind, (schema, []))[1].append(path)
    return list(groups.values())


def read_groups(
    spark: SparkSession, groups: Sequence[tuple[T.StructType, list[str]]], schema: T.StructType | None = TRANSACTIONS
) -> DataFrame:
    """Files of several schemas as one relation: each group is cast to the declared types, columns a group lacks are NULL.

    A column that no schema declares and that has several types is read as text. Without a schema nothing is cast
    otherwise: rows come as they are, to be checked.
    """
    kinds: dict[str, set[str]] = {}
    for found, _ in groups:
        for field in found.fields:
            kinds.setdefault(field.name, set()).add(field.dataType.json())
    declared = schema.fieldNames() if schema else []
    mixed = {name for name, types in kinds.items() if len(types) > 1 and name not in declared}
    out = empty_table(spark, schema or T.StructType())
    for n, (found, paths) in enumerate(groups):
        rows = spark.read.schema(found).parquet(*paths)
        rows = with_declared(rows, schema) if schema else rows
        rows = rows.select(*[F.col(c).cast("string").alias(c) if c in mixed else F.col(c) for c in rows.columns])
        out = rows if n == 0 else out.unionByName(rows, allowMissingColumns=True)
    return out


def _plain(path: Column) -> Column:
    """A path as text: what Spark says of a row's file is encoded, and has more slashes after the scheme."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^([A-Za-z0-9]+):/+", "$1:/")


def _profiled(spark: SparkSession, new: DataFrame) -> DataFrame:
    """Manifest rows of files not seen before: their schema, and the days, from one scan of the time column."""
    groups = file_groups(spark, [r["path"] for r in new.select("path").orderBy("path").collect()])
    found = spark.createDataFrame([], "file string, first_day date, last_day date, rows long, undated long")
    for schema, paths in groups:
        rows = spark.read.schema(schema).parquet(*paths)
        # A time that cannot be read is none.
        day = F.to_date((F.col(_TIME) if _TIME in rows.columns else F.lit(None)).try_cast("timestamp"))
        found = found.unionByName(
            rows.groupBy(_plain(F.col("_metadata.file_path")).alias("file")).agg(
                F.min(day).alias("first_day"), F.max(day).alias("last_day"),
                F.count("*").alias("rows"), F.count(F.when(day.isNull(), 1)).alias("undated"),
            )
        )
    schemas = [(path, json.dumps(schema.jsonValue())) for schema, paths in groups for path in paths]
    # Files without rows have no days, but are remembered too.
    return (
        new.join(spark.createDataFrame(schemas, "path string, schema string"), "path")
        .withColumn("file", F.regexp_replace("path", "^([A-Za-z0-9]+):/+", "$1:/"))
        .join(found, "file", "left")
        .fillna(0, ["rows", "undated"])
        .select(*MANIFEST.fieldNames())
    )


def refresh_manifest(spark: SparkSession, root: str, path: str) -> DataFrame:
    """Bring the manifest at ``path`` up to date with the files below ``root`` and return it.

    Files are told by path, time and length: new ones and those that changed are opened, those that are gone are dropped,
    all others stay as they are remembered.
    """
    settle_table(spark, path)
    known = read_table_or_empty(spark, path, MANIFEST)
    listed = listed_files(spark, root)
    same = ["path", "modified", "length"]
    both = listed.withColumn("here", F.lit(1)).join(known.select(*same, F.lit(1).alias("there")), same, "full")
    new, gone = both.agg(F.count(F.when(F.col("there").isNull(), 1)), F.count(F.when(F.col("here").isNull(), 1))).first()
    if not new and not gone:
        return known
    unseen = listed.join(known.select(*same), same, "left_anti")
    kept = known.join(listed, same, "left_semi")
    rewrite_table(kept.unionByName(_profiled(spark, unseen)) if new else kept, path)
    return read_table_or_empty(spark, path, MANIFEST)


def _by_schema(wanted: DataFrame) -> list[tuple[T.StructType, list[str]]]:
    groups: dict[str, list[str]] = {}
    for row in wanted.select("schema", "path").orderBy("path").collect():
        groups.setdefault(row["schema"], []).append(row["path"])
    return [(T.StructType.fromJson(json.loads(schema)), paths) for schema, paths in groups.items()]


def files_of_days(
    manifest: DataFrame, first: dt.date, last: dt.date
) -> list[tuple[T.StructType, list[str]]]:
    """The files that may hold rows of the days, by schema, as ``read_groups`` takes them."""
    return _by_schema(manifest.where((F.col("first_day") <= F.lit(last)) & (F.col("last_day") >= F.lit(first))))


def files_undated(manifest: DataFrame) -> list[tuple[T.StructType, list[str]]]:
    """The files with rows whose time is missing or cannot be read."""
    return _by_schema(manifest.where("undated > 0"))


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Raw transactions directory with the columns of its footers, all of which are read.

    Declared columns get their types, whatever types the files have, also if they differ between files; all others are kept.
    For a directory that grows, ``refresh_manifest`` opens each file once.
    """
    try:
        return with_declared(spark.read.option("mergeSchema", "true").parquet(path), TRANSACTIONS)
    except (PySparkException, Py4JJavaError) as error:
        if not _disagree(error):
            raise
    return read_groups(spark, file_groups(spark, [r["path"] for r in listed_files(spark, path).orderBy("path").collect()]))
