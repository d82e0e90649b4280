"""Day-by-day forms of three results, to compare the set-based ones with.

Each day reads what the day before wrote, as a daily schedule does. Not part of the library.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.queries import _deliveries, _numbered_events
from tallybook.functions.interest import held_interest, held_rate
from tallybook.operators.activity import activity_lag, activity_with_rate, daily_activity
from tallybook.operators.merge import upsert_partitioned
from tallybook.plans.payouts import payouts_day
from tallybook.plans.zones import Zones
from tallybook.schemas import (
    ACCOUNT_KEY,
    CURATED_TRANSACTIONS,
    LEDGER_COLUMNS,
    PAYOUTS,
    TRANSACTION_KEY,
)
from tallybook.sources import sample_tables as sample
from tallybook.sources import sinks
from tallybook.sources.tables import read_table
from tallybook.sources.workspace import fresh_dir

FIRST, LAST = dt.date(2024, 1, 1), dt.date(2024, 1, 30)


def _days(first: dt.date, last: dt.date):
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = fresh_dir(spark, "loop-ledger")
    active = activity_with_rate(
        activity_lag(daily_activity(sample.transactions(spark, sf_dir))),
        sample.rates(spark, sf_dir),
    )
    active.write.parquet(f"{base}/active")
    active = spark.read.parquet(f"{base}/active")
    balances = active.select(*ACCOUNT_KEY).distinct().withColumn("balance", F.lit(0.0))
    for day in _days(FIRST, LAST):
        today = active.where(F.to_date("event_date") == F.lit(day))
        rate = held_rate(F.col("valor_cdi"), F.col("event_time"), F.col("horario_saldo_elegivel"))
        opening = F.col("saldo_dia_anterior_corrigido")
        rows = (
            today.join(balances.withColumnRenamed("balance", "saldo_dia_anterior_corrigido"), ACCOUNT_KEY)
            .withColumn("cdi_diario", held_interest(opening, rate))
            .withColumn(
                "total", opening + F.col("movimentacao_dia").cast("double") + F.col("cdi_diario")
            )
        )
        rows.select(*LEDGER_COLUMNS).write.parquet(f"{base}/rows/day={day}")
        done = spark.read.parquet(f"{base}/rows/day={day}").select(*ACCOUNT_KEY, "total")
        balances.join(done, ACCOUNT_KEY, "left").select(
            *ACCOUNT_KEY, F.coalesce("total", "balance").alias("balance")
        ).write.parquet(f"{base}/balances/{day}")
        balances = spark.read.parquet(f"{base}/balances/{day}")
    return spark.read.parquet(f"{base}/rows").select(*LEDGER_COLUMNS)


def snapshot_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = Zones(fresh_dir(spark, "loop-chain"))
    sinks.write_partitioned(sample.dated_transactions(spark, sf_dir), zones.transactions)
    sinks.write_table(sample.rates(spark, sf_dir), zones.rates)
    for day in _days(FIRST, LAST):
        payouts_day(spark, zones, day)
    return read_table(spark, zones.payouts, PAYOUTS)


def merge_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = Zones(fresh_dir(spark, "loop-merge"))
    columns = CURATED_TRANSACTIONS.fieldNames()
    first, second = (d.select(*columns) for d in _deliveries(_numbered_events(spark, sf_dir), "event_id"))
    sinks.write_partitioned(first, zones.transactions)
    for day in _days(FIRST, LAST):
        upsert_partitioned(
            spark, zones.transactions, second.where(F.col("date") == F.lit(day)),
            TRANSACTION_KEY, CURATED_TRANSACTIONS, days=[day],
        )
    return read_table(spark, zones.transactions, CURATED_TRANSACTIONS)


LOOPS = {
    "ledger": ledger,
    "snapshot_chain": snapshot_chain,
    "merge_transactions": merge_transactions,
}
