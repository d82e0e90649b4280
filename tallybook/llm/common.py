"""What several of the operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.sources.workspace import materialized

# A word is a run of anything but ASCII white space. Fixed value.
WORD = r"[^\x20\x09-\x0D]+"

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Arrow batches of few rows: texts may be very long, and a batch is held whole in a task."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def width(spark: SparkSession) -> int:
    """Partitions of an explicit repartitioning: as many as the session's shuffles have."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def n_words(text: str | Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values; equal in, equal out. Overflow wraps."""
    values = values * _MIX
    return (values ^ (values >> _SHIFT)) * _MIX


def window_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of the ``length`` values that start at each position.

    Windows of 1, 2, 4, ... values are joined pairwise, so the cost grows with the logarithm
    of ``length``.
    """
    if len(data) < length:
        return np.empty(0, np.uint64)
    power, total, done = mix(data.astype(np.uint64) + np.uint64(1)), None, 0
    span, left = 1, length
    while left:
        if left & 1:
            part = power[done : len(data) - length + 1 + done]
            total = part if total is None else total * _factor(span) + part
            done += span
        left >>= 1
        if left:
            power = power[:-span] * _factor(-span) + power[span:]
            span *= 2
    return mix(total)


def _factor(of: int) -> np.uint64:
    """An odd number for each step of ``window_hashes``."""
    return mix(np.array([of], np.int64).view(np.uint64))[0] | np.uint64(1)


def sliding_min(values: np.ndarray, length: int) -> np.ndarray:
    """Minimum of the ``length`` values that start at each position."""
    span = 1
    while span * 2 <= length:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = length - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


__all__ = ["WORD", "materialized", "mix", "n_words", "read", "sliding_min", "small_batches", "width", "window_hashes"]
