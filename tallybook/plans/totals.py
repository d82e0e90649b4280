"""Keep the totals of accounts up to date, and read history through them."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.interest import as_date
from tallybook.operators.totals import carried_movements, totals_by_day, touched_accounts
from tallybook.plans.zones import Zones
from tallybook.schemas import CURATED_TRANSACTIONS, TOTALS, TOUCHED
from tallybook.sources import files
from tallybook.sources.sinks import overwrite_partitions
from tallybook.sources.tables import empty_table, read_days, read_table_or_empty

log = logging.getLogger(__name__)

# Tables that follow the transactions day by day, and so have to hear of late ones.
FOLLOWERS = ("totals", "payouts")
DAY = dt.timedelta(days=1)


def mark_touched(spark: SparkSession, zones: Zones, changed: DataFrame, days: Sequence[dt.date]) -> None:
    """Note the accounts among ``changed`` whose days a following table has passed. Call it before the rows are
    written: a note too many costs a restatement, one too few an error.

    ``changed`` is read only if one of ``days`` lies that far back, which it does not in a usual daily run.
    """
    for table in FOLLOWERS:
        passed = files.partition_days(spark, getattr(zones, table))
        if passed and days and min(days) <= passed[-1]:
            touched_accounts(changed, passed[-1]).write.mode("append").parquet(zones.touched(table))


def read_touched(spark: SparkSession, zones: Zones, table: str) -> DataFrame:
    return read_table_or_empty(spark, zones.touched(table), TOUCHED)


def clear_touched(spark: SparkSession, zones: Zones, table: str) -> None:
    files.remove(spark, zones.touched(table))


def history(spark: SparkSession, zones: Zones, first: dt.date, last: dt.date) -> DataFrame:
    """``user_id, account_id, amount, date`` with the same sums up to any day from ``first`` to ``last`` as all curated
    movements have: the last totals before ``first``, and the movements after those totals.

    Reads one partition of the totals and the days since. Without any totals it reads all movements.
    """
    before = [d for d in files.partition_days(spark, zones.totals) if d < first]
    if not before:
        tx = read_table_or_empty(spark, zones.transactions, CURATED_TRANSACTIONS)
        return carried_movements(empty_table(spark, TOTALS), tx.where(F.col("date") <= F.lit(last)))
    base = before[-1]
    days = [base + DAY * n for n in range(1, (last - base).days + 1)]
    return carried_movements(
        read_days(spark, zones.totals, TOTALS, [base]),
        read_days(spark, zones.transactions, CURATED_TRANSACTIONS, days),
    )


def refresh_totals(spark: SparkSession, zones: Zones, until: str | dt.date | None = None) -> None:
    """Restate totals from the earliest day that late movements touched, and add those of ``until``.

    All days are computed in one job from the last totals before them, so a late movement costs the days
    after it, not the whole history. Totals of a day stay as they are if nothing touched it.
    """
    days = files.partition_days(spark, zones.totals)
    first = read_touched(spark, zones, "totals").agg(F.min("date")).first()[0]
    wanted = [d for d in days if first is not None and d >= first]
    if until is not None and as_date(until) not in days:
        wanted.append(as_date(until))
    if wanted:
        log.info("totals of %s days from %s", len(wanted), min(wanted))
        movements = history(spark, zones, min(wanted), max(wanted))
        overwrite_partitions(totals_by_day(movements, wanted), zones.totals)
    if first is not None:
        clear_touched(spark, zones, "totals")
