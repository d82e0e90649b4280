"""Per-account sums around one business date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.interest import as_date
from tallybook.functions.keys import event_day
from tallybook.schemas import ACCOUNT_KEY


def filter_business_date(tx: DataFrame, business_date: str | dt.date) -> DataFrame:
    """Transactions of one day; on raw files Spark pushes this down as a time range."""
    return tx.where(F.to_date("event_time") == F.lit(as_date(business_date)))


def curate_transactions(tx: DataFrame, business_date: str | dt.date) -> DataFrame:
    """Transactions of one day with their ``date`` partition column."""
    return filter_business_date(tx, business_date).withColumn("date", F.to_date("event_time"))


def dated_between(tx: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Transactions of some days with their ``date`` partition column; pushed down as a time range as well."""
    day = F.to_date("event_time")
    return tx.where((day >= F.lit(first)) & (day <= F.lit(last))).withColumn("date", day)


def _summed(tx: DataFrame, name: str) -> DataFrame:
    return tx.groupBy(*ACCOUNT_KEY).agg(F.coalesce(F.sum("amount"), F.lit(0)).alias(name))


def movement_of_day(tx: DataFrame, business_date: str | dt.date) -> DataFrame:
    """Sum of the day's movements per account; all-NULL amounts count as 0."""
    day = F.lit(as_date(business_date))
    return _summed(tx.where(event_day(tx) == day), "movimentacao_dia")


def balance_until(tx: DataFrame, last_date: str | dt.date) -> DataFrame:
    """Sum of all movements up to and including ``last_date`` per account."""
    day = F.lit(as_date(last_date))
    return _summed(tx.where(event_day(tx) <= day), "saldo_ate_ontem_curated")


def accounts_today(tx: DataFrame, business_date: str | dt.date) -> DataFrame:
    """Accounts with a movement on the day or before it."""
    day = F.lit(as_date(business_date))
    return tx.where(event_day(tx) <= day).select(*ACCOUNT_KEY).distinct()


def previous_closing(payouts: DataFrame, business_date: str | dt.date) -> DataFrame:
    """Closing balances of the day before ``business_date``."""
    previous = as_date(business_date) - dt.timedelta(days=1)
    return payouts.where(F.col("date") == F.lit(previous)).select(
        *ACCOUNT_KEY, F.col("saldo_final").alias("prev_saldo_final")
    )
