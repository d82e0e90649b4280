"""Running sums per account, kept by day, that stand for all earlier movements."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions.keys import event_day
from tallybook.schemas import ACCOUNT_KEY, TOTALS

_MONEY = TOTALS["total"].dataType


def carried_movements(totals: DataFrame, tx: DataFrame) -> DataFrame:
    """Totals of one day as one movement per account on that day, and the movements after it.

    Every sum over all movements up to a later day is the same over these, and an account known
    by its total has earlier movements. The times of movements are of no account and are left out.
    """
    columns = [*ACCOUNT_KEY, "amount", "date"]
    return (
        totals.select(*ACCOUNT_KEY, F.col("total").alias("amount"), "date")
        .unionByName(tx.select(*ACCOUNT_KEY, F.col("amount").cast(_MONEY).alias("amount"), event_day(tx).alias("date")))
        .select(*columns)
    )


def totals_of(movements: DataFrame, day: dt.date) -> DataFrame:
    """Sum of all movements per account, as of a day; amounts that are all NULL sum to 0. One shuffle."""
    total = F.coalesce(F.sum("amount"), F.lit(0)).cast(_MONEY)
    return movements.groupBy(*ACCOUNT_KEY).agg(total.alias("total")).withColumn("date", F.lit(day)).select(*TOTALS.fieldNames())


def totals_by_day(movements: DataFrame, days: Sequence[dt.date]) -> DataFrame:
    """Totals as of each of the given days, in one job.

    Movements are summed per account and the first of the days that sees them, before the shuffle;
    what is then summed up and spread over later days has at most one row per account and day.
    """
    days = sorted(days)
    if len(days) == 1:
        return totals_of(movements.where(F.col("date") <= F.lit(days[0])), days[0])
    calendar = movements.sparkSession.createDataFrame(
        [(first, day, slot) for slot, (first, day) in enumerate(zip([days[0], *(d + dt.timedelta(days=1) for d in days)], days))],
        "since date, day date, slot int",
    )
    each = calendar.select("slot", F.explode(F.sequence("since", "day")).alias("seen"))
    summed = (
        movements.where(F.col("date") <= F.lit(days[-1]))
        .withColumn("seen", F.greatest("date", F.lit(days[0])))
        .join(F.broadcast(each), "seen")  # one row per calendar day
        .groupBy(*ACCOUNT_KEY, "slot")
        .agg(F.coalesce(F.sum("amount"), F.lit(0)).cast(_MONEY).alias("amount"))
    )
    of_account = Window.partitionBy(*ACCOUNT_KEY).orderBy("slot")
    running = F.sum("amount").over(of_account.rowsBetween(Window.unboundedPreceding, 0)).cast(_MONEY)
    until = F.coalesce(F.lead("slot").over(of_account), F.lit(len(days))) - 1
    spread = summed.select(*ACCOUNT_KEY, running.alias("total"), "slot", until.alias("until"))
    return (
        spread.select(*ACCOUNT_KEY, "total", F.explode(F.sequence("slot", "until")).alias("slot"))
        .join(F.broadcast(calendar.select("slot", F.col("day").alias("date"))), "slot")
        .select(*TOTALS.fieldNames())
    )


def touched_accounts(changed: DataFrame, last: dt.date) -> DataFrame:
    """Accounts and their first day among rows that reach back to ``last`` or before it."""
    day = event_day(changed)
    return changed.where(day <= F.lit(last)).groupBy(*ACCOUNT_KEY).agg(F.min(day).alias("date"))
