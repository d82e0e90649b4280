"""Key checks and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.keys import all_present


def key_quality(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: all rows, rows with a NULL key, keys that repeat, and rows too many."""
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    keyed = all_present(keys)
    repeated = keyed & (F.col("n") > 1)
    zero = F.lit(0)
    return per_key.agg(
        F.coalesce(F.sum("n"), zero).cast("long").alias("total_rows"),
        F.coalesce(F.sum(F.when(~keyed, F.col("n"))), zero).cast("long").alias("null_key_rows"),
        F.count(F.when(repeated, 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("n") - 1)), zero)
        .cast("long").alias("surplus_rows"),
    )


def _greatest(
    rows: DataFrame, group: Sequence[str], latest_by: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """One row per group. Columns after ``latest_by`` break ties, so the choice is fixed.

    The maximum is combined before the shuffle: a key with very many copies never gathers
    in one task.
    """
    rest = [c for c in columns if c not in group]
    order = [c for c in latest_by if c in rest] + [c for c in rest if c not in latest_by]
    if not order:
        return rows.select(*group).distinct().select(*columns)
    kept = rows.groupBy(*group).agg(F.max(F.struct(*order)).alias("kept"))
    return kept.select(*group, "kept.*").select(*columns)


def latest_per_key(
    rows: DataFrame, keys: Sequence[str], latest_by: Sequence[str] = ()
) -> DataFrame:
    """The row with the greatest ``latest_by`` per key, of the rows that have one."""
    return _greatest(rows.where(all_present(keys)), list(keys), latest_by, rows.columns)


def unkeyed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.where(~all_present(keys))


def dedup_latest(
    rows: DataFrame, keys: Sequence[str], latest_by: Sequence[str] = ()
) -> DataFrame:
    """One row per key, the latest; rows with a NULL key all stay, past the shuffle."""
    return latest_per_key(rows, keys, latest_by).unionByName(unkeyed(rows, keys))
