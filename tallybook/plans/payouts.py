"""Curated to payouts, for one business date or a range, and again after late movements."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.interest import as_date
from tallybook.operators.chain import snapshot_chain
from tallybook.operators.merge import upsert_partitioned
from tallybook.operators.snapshot import daily_snapshot
from tallybook.plans.totals import DAY, clear_touched, history, read_touched, refresh_totals
from tallybook.plans.zones import Zones
from tallybook.schemas import ACCOUNT_KEY, PAYOUT_KEY, PAYOUTS, RATES
from tallybook.sources import files
from tallybook.sources.rates import rate_lookup
from tallybook.sources.sinks import settle_table
from tallybook.sources.tables import read_days, read_table_or_empty

log = logging.getLogger(__name__)


def read_rates(spark: SparkSession, zones: Zones) -> DataFrame:
    """Curated rates, also if replacing them was cut off."""
    settle_table(spark, zones.rates)
    return read_table_or_empty(spark, zones.rates, RATES)


def payouts_day(spark: SparkSession, zones: Zones, business_date: str | dt.date) -> None:
    """Upsert the day's payouts; a day without a rate or without accounts writes nothing.

    Earlier movements are read through the totals, so a day's run scans its own partition, those since the last
    totals, and one of the totals; then it leaves totals of its own. Late movements that curation noted are in them.
    """
    day = as_date(business_date)
    refresh_totals(spark, zones)
    movements = history(spark, zones, day, day)
    if movements.isEmpty():
        log.info("no transactions until %s", day)
        return
    rates = read_rates(spark, zones)
    if rate_lookup(rates, day).isEmpty():
        log.info("no rate for %s", day)
        return
    previous = read_days(spark, zones.payouts, PAYOUTS, [day - DAY])
    rows = daily_snapshot(movements, rates, previous, day)
    # One row per account already, so nothing needs to be de-duplicated.
    upsert_partitioned(
        spark, zones.payouts, rows, PAYOUT_KEY, PAYOUTS,
        days=[day], on_duplicate="keep_all", materialize=True,
    )
    refresh_totals(spark, zones, day)


def payouts_range(
    spark: SparkSession,
    zones: Zones,
    from_date: str | dt.date,
    to_date: str | dt.date,
) -> None:
    """Upsert the payouts of every day in the range with one set-based job.

    Continues from payouts of the day before the range and from the last totals before it. Use
    ``restate_payouts`` for days whose transactions arrive late.
    """
    first, last = as_date(from_date), as_date(to_date)
    rates = read_rates(spark, zones).where(F.col("date").between(F.lit(first), F.lit(last)))
    if rates.isEmpty():
        log.info("no rate from %s to %s", first, last)
        return
    refresh_totals(spark, zones)
    movements = history(spark, zones, first, last)
    previous = read_table_or_empty(spark, zones.payouts, PAYOUTS)
    rows = snapshot_chain(movements, rates, previous=previous)
    upsert_partitioned(
        spark, zones.payouts, rows, PAYOUT_KEY, PAYOUTS,
        days=rates, on_duplicate="keep_all", materialize=True,
    )
    refresh_totals(spark, zones, last)


def restate_payouts(spark: SparkSession, zones: Zones) -> None:
    """Bring stored payouts up to date after movements of days they had passed.

    Only accounts that curation noted are folded again, from the day the first of them was touched: their
    closing balances of the day before, their totals, and their movements since. All other accounts are
    filtered out before anything is shuffled, and their rows stay. The result is that of computing all days anew.
    Accounts with a NULL id hold zero balances and are not restated.
    """
    touched = read_touched(spark, zones, "payouts")
    first = touched.agg(F.min("date")).first()[0]
    if first is None:
        return
    refresh_totals(spark, zones)
    days = [d for d in files.partition_days(spark, zones.payouts) if d >= first]
    if days:
        rows = restated_rows(spark, zones, touched, first, days)
        upsert_partitioned(
            spark, zones.payouts, rows, PAYOUT_KEY, PAYOUTS,
            days=days, on_duplicate="keep_all", materialize=True,
        )
    clear_touched(spark, zones, "payouts")


def restated_rows(
    spark: SparkSession, zones: Zones, touched: DataFrame, first: dt.date, days: list[dt.date]
) -> DataFrame:
    """Payouts of the touched accounts on the given days, continued from what was stored before ``first``."""
    accounts = touched.select(*ACCOUNT_KEY).distinct()
    movements = history(spark, zones, first, days[-1]).join(accounts, ACCOUNT_KEY, "left_semi")
    rates = read_rates(spark, zones).where(F.col("date").isin(days))
    previous = read_days(spark, zones.payouts, PAYOUTS, [days[0] - DAY])
    return snapshot_chain(movements, rates, previous=previous)
