"""Key predicates shared by merges and quality checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def event_day(tx: DataFrame) -> Column:
    """Day of a transaction: the partition column where there is one, so files are pruned."""
    return F.col("date") if "date" in tx.columns else F.to_date("event_time")
