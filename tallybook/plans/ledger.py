"""The ledger as a table that grows: each run folds the days that are new."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.interest import as_date
from tallybook.operators.ledger import continue_ledger, ledger_state
from tallybook.plans.payouts import read_rates
from tallybook.plans.totals import DAY
from tallybook.plans.zones import Zones
from tallybook.schemas import CURATED_TRANSACTIONS, LEDGER, LEDGER_STATE
from tallybook.sources import files
from tallybook.sources.sinks import overwrite_partitions
from tallybook.sources.tables import empty_table, read_days, read_table_or_empty
from tallybook.sources.workspace import scratch

log = logging.getLogger(__name__)


def ledger_until(spark: SparkSession, zones: Zones, to_date: str | dt.date, from_date: str | dt.date | None = None) -> None:
    """Extend the ledger up to a day, from where it stands.

    The last state before the new days holds each account's balance and last active day, so
    only movements since are read and folded. ``from_date`` goes back to the last state before that day and
    folds its rows again, as movements that arrive late need; any state of a former run serves. Without a state
    all movements are folded. Repeating a run changes nothing.
    """
    last = as_date(to_date)
    states = files.partition_days(spark, zones.ledger_state)
    before = [d for d in states if d < (last if from_date is None else as_date(from_date))]
    if not before:
        state = empty_table(spark, LEDGER_STATE)
        tx = read_table_or_empty(spark, zones.transactions, CURATED_TRANSACTIONS).where(F.col("date") <= F.lit(last))
    else:
        state = read_days(spark, zones.ledger_state, LEDGER_STATE, [before[-1]])
        days = [before[-1] + DAY * n for n in range(1, (last - before[-1]).days + 1)]
        tx = read_days(spark, zones.transactions, CURATED_TRANSACTIONS, days)
    log.info("ledger from %s to %s", before[-1] if before else "the first movement", last)
    with scratch(spark) as copies:
        rows = copies.keep(continue_ledger(tx, read_rates(spark, zones), state), "ledger")
        dated = rows.withColumn("date", F.to_date("event_date"))
        overwrite_partitions(_typed(dated, LEDGER), zones.ledger)
        # The state is written last: without it the days count as not folded.
        stands = ledger_state(rows, state).withColumn("date", F.lit(last))
        overwrite_partitions(_typed(stands, LEDGER_STATE), zones.ledger_state)


def _typed(rows: DataFrame, schema) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
