"""Raw to curated, for one business date or a range."""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.interest import as_date
from tallybook.operators.balances import dated_between
from tallybook.operators.merge import partition_days, upsert_partitioned, upsert_table
from tallybook.operators.rules import TRANSACTION_RULES, Rules, validated
from tallybook.plans.totals import mark_touched
from tallybook.plans.zones import Zones
from tallybook.schemas import CURATED_TRANSACTIONS, RATE_KEY, RATES, TRANSACTION_KEY
from tallybook.sources import files
from tallybook.sources.manifest import files_of_days, files_undated, read_groups, refresh_manifest
from tallybook.sources.rates import curate_rates, landed_payloads, read_landed_days, read_landed_rates, rescue_rates
from tallybook.sources.sinks import overwrite_partitions
from tallybook.sources.workspace import scratch

log = logging.getLogger(__name__)


def curate_day(
    spark: SparkSession, zones: Zones, business_date: str | dt.date, **policy
) -> None:
    """Upsert the day's transactions and rate; either is skipped when there is none.

    ``policy`` is that of ``upsert_partitioned``. By default all movements that repeat a key are
    kept when they are first written, and a repeated delivery of such a day fails: name what makes
    a row the latest (``on_duplicate="latest"``, ``latest_by``) to curate it again.
    """
    curate_range(spark, zones, business_date, business_date, **policy)


def curate_range(
    spark: SparkSession, zones: Zones, from_date: str | dt.date, to_date: str | dt.date, **policy
) -> None:
    """Upsert the transactions and rates of all days from one to the other; the same rows as ``curate_day`` for each of them.

    Only raw files that hold one of the days are opened, once; the manifest knows which, and what columns they have.
    """
    first, last = as_date(from_date), as_date(to_date)
    manifest = refresh_manifest(spark, zones.raw_transactions, zones.manifest)
    groups = files_of_days(manifest, first, last)
    if groups:
        curate_transactions_range(spark, zones, read_groups(spark, groups), first, last, **policy)
    else:
        log.info("no transactions from %s to %s", first, last)
    curate_rate_range(spark, zones, first, last)


def curate_validated(
    spark: SparkSession, zones: Zones, from_date: str | dt.date, to_date: str | dt.date,
    rules: Rules = TRANSACTION_RULES, **policy,
) -> None:
    """As ``curate_range``, for transactions that keep the rules; all others go to the table of rejected rows.

    The raw files are read once. Rejected rows replace those of their days, so a run can be repeated. Rows whose time
    is missing or cannot be read belong to no day: those of all files that have any are rejected together.
    """
    first, last = as_date(from_date), as_date(to_date)
    manifest = refresh_manifest(spark, zones.raw_transactions, zones.manifest)
    groups = files_of_days(manifest, first, last)
    with scratch(spark) as copies:
        if groups:
            raw = read_groups(spark, groups, schema=None)
            when = F.to_date(F.col("event_time").try_cast("timestamp"))
            raw = raw.where((when >= F.lit(first)) & (when <= F.lit(last)))
            accepted, rejected = validated(raw, rules, lambda rows: copies.keep(rows, "checked"))
            curate_transactions_range(spark, zones, accepted, first, last, **policy)
            _replace_rejected(spark, zones, rejected, first, last)
        undated = files_undated(manifest)
        if undated:
            raw = read_groups(spark, undated, schema=None)
            when = F.col("event_time").try_cast("timestamp") if "event_time" in raw.columns else F.lit(None)
            _, rejected = validated(raw.where(when.isNull()), replace(rules, keys=()), lambda rows: copies.keep(rows, "undated"))
            overwrite_partitions(_rejected_rows(rejected), zones.rejected)


def _rejected_rows(rejected: DataFrame) -> DataFrame:
    return rejected.select("account_id", "event_time", "reasons", "raw", F.to_date("event_time").alias("date"))


def _replace_rejected(spark: SparkSession, zones: Zones, rejected: DataFrame, first: dt.date, last: dt.date) -> None:
    """Days whose rows are all sound by now lose the rejected rows they had."""
    days = set(partition_days(_rejected_rows(rejected), "date"))
    for day in files.partition_days(spark, zones.rejected):
        if first <= day <= last and day not in days:
            files.remove(spark, f"{zones.rejected}/date={day.isoformat()}")
    if days:
        overwrite_partitions(_rejected_rows(rejected), zones.rejected)


def curate_transactions_day(
    spark: SparkSession, zones: Zones, raw: DataFrame, day: dt.date, **policy
) -> None:
    curate_transactions_range(spark, zones, raw, day, day, **policy)


def curate_transactions_range(
    spark: SparkSession, zones: Zones, raw: DataFrame, first: dt.date, last: dt.date, **policy
) -> None:
    """Upsert the raw rows of some days. They are scanned once and staged, whatever reads them afterwards."""
    with scratch(spark) as copies:
        arrived = copies.keep(dated_between(raw, first, last), "arrived")
        days = partition_days(arrived, "date")
        if not days:
            log.info("no transactions from %s to %s", first, last)
            return
        mark_touched(spark, zones, arrived, days)
        upsert_partitioned(
            spark, zones.transactions, arrived, TRANSACTION_KEY, CURATED_TRANSACTIONS, days=days, **policy
        )


def curate_rate_day(spark: SparkSession, zones: Zones, day: dt.date) -> None:
    arrived = curate_rates(read_landed_rates(spark, zones.raw_rates, day), day)
    if arrived.isEmpty():
        log.info("no rate for %s", day)
        return
    upsert_table(spark, zones.rates, arrived, RATE_KEY, RATES, on_duplicate="latest", latest_by=["valor"])


def rescue_landed_rates(spark: SparkSession, zones: Zones, from_date: str | dt.date, to_date: str | dt.date) -> None:
    """Look through landed rate files of some days, whoever wrote them, and keep faulty payloads and records apart."""
    payloads = landed_payloads(spark, zones.raw_rates, as_date(from_date), as_date(to_date))
    rescue_rates(payloads, zones.rescued_rates)


def curate_rate_range(spark: SparkSession, zones: Zones, first: dt.date, last: dt.date) -> None:
    """Upsert the landed rates of some days in one go; the landing date is the key."""
    if first == last:
        curate_rate_day(spark, zones, first)
        return
    arrived = read_landed_days(spark, zones.raw_rates, first, last)
    if arrived.isEmpty():
        log.info("no rates from %s to %s", first, last)
        return
    upsert_table(spark, zones.rates, arrived, RATE_KEY, RATES, on_duplicate="latest", latest_by=["valor"])
