"""Per-account activity by day, with look-back and the day's rate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions.interest import as_date
from tallybook.schemas import ACCOUNT_KEY
from tallybook.sources.rates import unique_rates


def only_accounts(tx: DataFrame, accounts: DataFrame | Sequence[str] | None) -> DataFrame:
    """Restrict to given account ids: a short list, or a frame with ``account_id``."""
    if accounts is None:
        return tx
    if isinstance(accounts, DataFrame):
        return tx.join(accounts.select("account_id").distinct(), "account_id", "left_semi")
    return tx.where(F.col("account_id").isin(list(accounts)))


def daily_activity(tx: DataFrame) -> DataFrame:
    """Sum of the movements and time of the last one, per account and active day.

    This is where transactions shrink to at most one row per account and calendar day; the
    sums are combined before the shuffle, so a very busy account costs no more than others.
    """
    return tx.groupBy(
        *ACCOUNT_KEY, F.date_trunc("day", "event_time").alias("event_date")
    ).agg(
        F.sum("amount").alias("movimentacao_dia"),
        F.max("event_time").alias("event_time"),
    )


def activity_lag(activity: DataFrame) -> DataFrame:
    """Add the previous active day's movement (0 at first) and time of its last event."""
    w = Window.partitionBy(*ACCOUNT_KEY).orderBy("event_date")
    previous = F.lag("movimentacao_dia").over(w)
    return activity.select(
        *ACCOUNT_KEY,
        "event_date",
        F.coalesce(previous, F.lit(0)).alias("saldo_dia_anterior"),
        "movimentacao_dia",
        F.lag("event_time").over(w).alias("horario_saldo_elegivel"),
        "event_time",
        *[c for c in activity.columns if c == "stored_balance"],
    )


def activity_between(
    activity: DataFrame,
    from_date: str | dt.date | None = None,
    to_date: str | dt.date | None = None,
) -> DataFrame:
    """Bound the days. Apply after the look-back, which may reach before ``from_date``."""
    day = F.to_date("event_date")
    bounded = activity.where(F.col("event_date").isNotNull())
    if from_date is not None:
        bounded = bounded.where(day >= F.lit(as_date(from_date)))
    if to_date is not None:
        bounded = bounded.where(day <= F.lit(as_date(to_date)))
    return bounded


def activity_with_rate(activity: DataFrame, rates: DataFrame) -> DataFrame:
    """Add the day's rate in percent, 0.0 on days without one."""
    by_day = F.broadcast(
        unique_rates(rates).select(F.col("date").alias("rate_day"), F.col("valor").alias("valor_cdi"))
    )
    return (
        activity
        .join(by_day, F.to_date("event_date") == F.col("rate_day"), "left")
        .drop("rate_day")
        .fillna({"valor_cdi": 0.0})
    )


def union_days(days: Sequence[DataFrame]) -> DataFrame:
    """All rows of several frames with the same columns."""
    return reduce(DataFrame.unionByName, days)
