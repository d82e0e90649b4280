"""The three stages of one business date, in order."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import SparkSession

from tallybook.functions.interest import as_date
from tallybook.plans.curate import curate_day
from tallybook.plans.payouts import payouts_day
from tallybook.plans.zones import Zones
from tallybook.sources.rates import land_rates

log = logging.getLogger(__name__)


def land_rate_day(
    spark: SparkSession, zones: Zones, business_date: str | dt.date, payload: str | None
) -> None:
    """Land the answer of the rate service for one day; an empty one writes nothing, what is faulty is kept apart."""
    if not payload:
        log.warning("no rate payload for %s", business_date)
        return
    land_rates(
        spark.createDataFrame(
            [(as_date(business_date), payload)], "date date, payload string"
        ),
        zones.raw_rates,
        rescue=zones.rescued_rates,
    )


def run_day(
    spark: SparkSession, zones: Zones, business_date: str | dt.date, payload: str | None, **policy
) -> None:
    """Land the rate, curate the day, and write its payouts. Repeating a day is harmless.

    ``policy`` is that of ``upsert_partitioned``. By default all rows delivered for a key take the place of those
    stored for it, so movements of one account in one instant can be curated again.
    """
    land_rate_day(spark, zones, business_date, payload)
    curate_day(spark, zones, business_date, **{"on_duplicate": "replace", **policy})
    payouts_day(spark, zones, business_date)
