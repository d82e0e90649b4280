"""Key-based upsert as DataFrame joins, for tables of plain files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybook.functions.keys import all_present
from tallybook.operators.quality import dedup_latest, latest_per_key
from tallybook.sources.sinks import append_partitions, overwrite_partitions, rewrite_table, settle_table, write_table
from tallybook.sources.tables import find_partitions, find_stored
from tallybook.sources.workspace import scratch

DUPLICATE_POLICIES = ("error", "keep_all", "latest", "replace", "distinct")
# Rows with a NULL key match nothing. As join keys they would all hash to one task, so they are spread.
_SPREAD, _SPREADS = "__spread", 1 << 12


def check_policy(on_duplicate: str, latest_by: Sequence[str]) -> None:
    if on_duplicate not in DUPLICATE_POLICIES:
        raise ValueError(f"on_duplicate must be one of {DUPLICATE_POLICIES}")
    if on_duplicate == "latest" and not latest_by:
        raise ValueError("latest needs latest_by: columns that tell which row is the latest")


def _one_spread(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The other side of ``_spread``: always 0, but computed, since a literal would be no join key."""
    return rows.withColumn(_SPREAD, F.hash(*keys).bitwiseAND(F.lit(0)))


def _spread(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    by_content = F.pmod(F.xxhash64(*rows.columns), F.lit(_SPREADS))
    return rows.withColumn(_SPREAD, F.when(all_present(keys), F.lit(0)).otherwise(by_content).cast("int"))


def matched_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    on_duplicate: str = "error",
    latest_by: Sequence[str] = (),
) -> DataFrame:
    """Every row of ``target`` as the upsert leaves it, and ``__copies``: source rows of its key, NULL if none.

    One scan and at most one shuffle of the target. It is the streamed side of a left join, so AQE can
    broadcast a small source and can split a skewed target key; a full outer join would allow neither.
    """
    keys = list(keys)
    source_only = [c for c in source.columns if c not in target.columns]
    row = F.struct(*source.columns).alias("__new")
    by = [*keys, _SPREAD]
    keyed_source = _one_spread(source.where(all_present(keys)), keys)
    if on_duplicate == "latest":
        keyed_source = latest_per_key(keyed_source, by, latest_by)
    if on_duplicate in ("error", "replace"):
        # For keys that repeat the row is not used: matching one is a failure, or all of them are taken.
        changes = keyed_source.groupBy(*by).agg(F.count(F.lit(1)).alias("__copies"), F.max(row).alias("__new"))
    else:
        changes = keyed_source.select(*by, F.lit(1).cast("long").alias("__copies"), row)
    joined = _spread(target, keys).join(changes, by, "left").drop(_SPREAD)
    if on_duplicate == "error":
        message = F.lit("several source rows match one target row")
        # The row number keeps the check above the join: below it, keys that match nothing would fail too.
        several = (F.col("__copies") > 1) & (F.monotonically_increasing_id() >= 0)
        joined = joined.where(F.when(several, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))

    def chosen(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name in source_only:
            return F.col("__new")[name].alias(name)
        if name not in source.columns:
            return F.col(name)
        return F.when(F.col("__copies").isNotNull(), F.col("__new")[name]).otherwise(
            F.col(name)
        ).alias(name)

    return joined.select(*[chosen(c) for c in target.columns + source_only], "__copies")


def _without(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not among the known ones; rows with a NULL key are not."""
    known = _one_spread(known.select(*keys), keys)
    return _spread(rows, keys).join(known, [*keys, _SPREAD], "left_anti").drop(_SPREAD)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    on_duplicate: str = "error",
    latest_by: Sequence[str] = (),
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows of ``target`` after an upsert of ``source``; nothing is ever deleted.

    A matched row takes every column the source has, an unmatched source row is inserted.
    Columns only one side has are kept: NULL on old rows, or on inserted ones. NULL keys
    match nothing. Source rows that repeat a key follow ``on_duplicate``:

    * ``error``: fail if several match one target row, insert all of them otherwise
    * ``keep_all``: all of them replace the matched row, and so for every matched row
    * ``latest``: only the one with the greatest ``latest_by`` counts, which must be given
    * ``replace``: all rows of a key take the place of all target rows with it, so that repeating an upsert changes
      nothing; columns only the target has come from the key's greatest row

    Which source rows are new is told from the matched rows. ``stage`` writes those and hands them back, so that
    the target is scanned and shuffled once; without it the plan scans the target's keys again.
    """
    check_policy(on_duplicate, latest_by)
    if on_duplicate == "distinct":
        return merge_distinct(target, source)
    keys = list(keys)
    kept = matched_rows(target, source, keys, on_duplicate=on_duplicate, latest_by=latest_by)
    kept = stage(kept) if stage else kept
    matched = kept.where(F.col("__copies").isNotNull())
    if on_duplicate == "latest":
        source = dedup_latest(source, keys, latest_by)
    if on_duplicate == "replace":
        return _replaced(kept.where(F.col("__copies").isNull()), matched, source, keys)
    return kept.drop("__copies").unionByName(_without(source, matched, keys), allowMissingColumns=True)


def new_rows(target: DataFrame, source: DataFrame) -> DataFrame:
    """Each source row that no target row equals in the columns both have, once.

    Rows are compared by all of these columns, so only equal rows meet in a task and no key can be hot; equal
    ones are put together before the shuffle. NULL equals NULL here. Of source rows that differ only in
    columns the target lacks the greatest is taken.
    """
    shared = [c for c in source.columns if c in target.columns]
    own = [c for c in source.columns if c not in shared]
    if own:
        once = source.groupBy(*shared).agg(F.max(F.struct(*own)).alias("__own")).select(*shared, "__own.*")
    else:
        once = source.distinct()
    known = target.select(*[F.col(c).alias(f"__{c}") for c in shared]).distinct()
    same = [once[c].eqNullSafe(known[f"__{c}"]) for c in shared]
    return once.join(known, same, "left_anti").select(*source.columns)


def merge_distinct(target: DataFrame, source: DataFrame) -> DataFrame:
    """All target rows, and the new ones of the source."""
    return target.unionByName(new_rows(target, source), allowMissingColumns=True)


def _replaced(untouched: DataFrame, matched: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    old = [c for c in matched.columns if c not in source.columns and c != "__copies"]
    if old:
        carried = _one_spread(matched, keys).groupBy(*keys, _SPREAD).agg(F.max(F.struct(*old)).alias("__old"))
        source = _spread(source, keys).join(carried, [*keys, _SPREAD], "left")
        source = source.select("*", *[F.col("__old")[c].alias(c) for c in old]).drop("__old", _SPREAD)
    return untouched.drop("__copies").unionByName(source)


def partition_days(days: DataFrame | Sequence[dt.date], partition: str) -> list[dt.date | None]:
    """Distinct partition values; at most one per calendar day ever reaches the driver."""
    if isinstance(days, DataFrame):
        return [row[0] for row in days.select(partition).distinct().collect()]
    return list(days)


def within_days(
    source: DataFrame, days: Sequence[dt.date | None], partition: str
) -> DataFrame:
    """Fail on rows of other days: their partitions would be replaced without being read."""
    here = F.col(partition)
    expected = here.isin([d for d in days if d is not None])
    if None in days:
        expected = expected | here.isNull()
    other = F.raise_error(F.lit(f"source rows outside the given {partition} partitions"))
    return source.where(F.when(expected, F.lit(True)).otherwise(other.cast("boolean")))


def upsert_partitioned(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    schema: StructType,
    *,
    partition: str = "date",
    days: DataFrame | Sequence[dt.date] | None = None,
    on_duplicate: str = "error",
    latest_by: Sequence[str] = (),
    materialize: bool = False,
) -> None:
    """Upsert into a partitioned table, creating it on the first call.

    Only touched partitions are read and rewritten, which is sound because every key here
    contains or determines the partition column. ``days`` names them when the caller knows,
    which spares a pass over the source. Partitions that hold nothing yet, the usual case of
    a daily run, are written without any join. Otherwise the source is evaluated more than
    once; ``materialize`` one that is expensive.
    """
    check_policy(on_duplicate, latest_by)
    touched = partition_days(source if days is None else days, partition)
    if not touched:
        return
    if days is not None:
        source = within_days(source, touched, partition)
    target = find_partitions(spark, path, schema, touched, partition)
    if target is None or target.isEmpty():
        first = dedup_latest(source, keys, latest_by) if on_duplicate == "latest" else source
        overwrite_partitions(first.distinct() if on_duplicate == "distinct" else first, path, partition)
        return
    if on_duplicate == "distinct":
        # Stored rows stay as they are. A run that was cut off is repeated: what it wrote is known by then.
        append_partitions(new_rows(target, source), path, partition)
        return
    with scratch(spark) as copies:
        if materialize:
            source = copies.keep(source, "upsert")
        merged = merge_upsert(
            target, source, keys, on_duplicate=on_duplicate, latest_by=latest_by,
            stage=lambda rows: copies.keep(rows, "matched"),
        )
        overwrite_partitions(merged, path, partition)


def upsert_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    schema: StructType,
    *,
    on_duplicate: str = "error",
    latest_by: Sequence[str] = (),
) -> None:
    """Upsert into a small unpartitioned table, creating it on the first call."""
    check_policy(on_duplicate, latest_by)
    settle_table(spark, path)
    target = find_stored(spark, path, schema)
    if target is None:
        first = dedup_latest(source, keys, latest_by) if on_duplicate == "latest" else source
        write_table(first.distinct() if on_duplicate == "distinct" else first, path)
        return
    merged = merge_upsert(target, source, keys, on_duplicate=on_duplicate, latest_by=latest_by)
    rewrite_table(merged, path)
