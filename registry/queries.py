"""Every operator as a query over the sample tables.

Compared outputs hold only strings, dates, longs and doubles, so any engine can check them.
Queries that write use a fresh folder in the shared workspace and return what they read back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.interest import exact_sum, gap_hours
from tallybook.operators import activity as act
from tallybook.operators import balances as bal
from tallybook.operators.chain import snapshot_chain
from tallybook.operators.ledger import ledger, ledger_report
from tallybook.operators.merge import merge_upsert, upsert_partitioned, upsert_table
from tallybook.operators.quality import dedup_latest, key_quality
from tallybook.operators.rules import TRANSACTION_RULES, reasons_report, validated
from tallybook.operators.snapshot import daily_snapshot
from tallybook.plans.curate import curate_day, curate_range, curate_rate_day, curate_transactions_day, curate_validated
from tallybook.plans.ledger import ledger_until
from tallybook.plans.payouts import payouts_day, payouts_range, restate_payouts
from tallybook.plans.totals import refresh_totals
from tallybook.plans.zones import Zones
from tallybook.schemas import (
    ACCOUNT_KEY,
    CURATED_TRANSACTIONS,
    LEDGER,
    LEDGER_COLUMNS,
    PAYOUT_KEY,
    PAYOUTS,
    RATE_KEY,
    RATES,
    TOTALS,
    TRANSACTION_KEY,
    TRANSACTIONS,
)
from tallybook.sources import rates as rate_source
from tallybook.sources import sample_tables as sample
from tallybook.sources import sinks
from tallybook.sources.manifest import listed_files, read_transactions, refresh_manifest
from tallybook.sources.tables import empty_table, read_table, table_exists
from tallybook.sources.workspace import fresh_dir
from tallybook.streaming.arrivals import curate_arrivals
from tallybook.streaming.rates import curate_rate_arrivals

# Run dates of the sample month: a Wednesday, its eve, a Saturday, and a redelivered span.
DAY = dt.date(2024, 1, 17)
EVE = dt.date(2024, 1, 16)
WEEKEND = dt.date(2024, 1, 20)
AFTER_DATA = dt.date(2024, 3, 1)
REDELIVERY_FROM = dt.date(2024, 1, 11)
FIRST_DELIVERY_TO = dt.date(2024, 1, 20)

PAYOUT_SUMS = ("movimentacao_dia", "juros_calculado", "saldo_final")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def _text(time: str):
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(time)


def _comparable(rows: DataFrame) -> DataFrame:
    """Timestamps to text, decimals to doubles, ``event_date`` to a date."""
    columns = []
    for field in rows.schema.fields:
        kind = field.dataType.typeName()
        if field.name == "event_date":
            columns.append(F.to_date(field.name).alias(field.name))
        elif kind == "timestamp":
            columns.append(_text(field.name))
        elif kind == "decimal":
            columns.append(F.col(field.name).cast("double").alias(field.name))
        else:
            columns.append(F.col(field.name))
    return rows.select(*columns)


def _zones(spark: SparkSession, name: str) -> Zones:
    return Zones(fresh_dir(spark, name))


def _corrected(tx: DataFrame) -> DataFrame:
    return tx.withColumn("amount", (F.col("amount") + F.lit(1)).cast("decimal(18,2)"))


def _deliveries(tx: DataFrame, number: str) -> tuple[DataFrame, DataFrame]:
    """Two thirds of the rows, then two thirds with a correction: every day has rows that are
    kept, updated and inserted."""
    return tx.where(F.col(number) % 3 != 0), _corrected(tx.where(F.col(number) % 3 != 1))


def _numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.transactions_from_events(spark, sf_dir).withColumn("date", F.to_date("event_time"))


def _eve_payouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_snapshot(
        sample.dated_transactions(spark, sf_dir), sample.rates(spark, sf_dir),
        empty_table(spark, PAYOUTS), EVE,
    )


# --- sources ---

@query("scan_transactions")
def scan_transactions(spark, sf_dir):
    zones = _zones(spark, "scan")
    sample.transactions(spark, sf_dir).write.parquet(zones.raw_transactions)
    return _comparable(read_transactions(spark, zones.raw_transactions))


@query("scan_rates_json")
def scan_rates_json(spark, sf_dir):
    zones = _zones(spark, "scan-rates")
    rate_source.land_rates(sample.rate_payloads(sample.rates(spark, sf_dir)), zones.raw_rates)
    return rate_source.read_landed_rates(spark, zones.raw_rates)


def _careless_payloads(spark, sf_dir) -> DataFrame:
    """Rate answers, some cut off, some of another day, some without a number, some empty."""
    day = F.dayofmonth("date")
    good = sample.rate_payloads(sample.rates(spark, sf_dir))
    return good.select(
        "date",
        F.when(day % 7 == 1, F.substring("payload", 1, 20))
        .when(day % 7 == 2, F.replace("payload", F.lit('"valor":"'), F.lit('"valor":"x')))
        .when(day % 7 == 3, F.regexp_replace("payload", r"/20\d\d", "/1999"))
        .when(day % 7 == 4, F.lit("[]"))
        .otherwise(F.col("payload")).alias("payload"),
    )


@query("rates_rejected")
def rates_rejected(spark, sf_dir):
    """Faulty answers kept apart while landing, and those that a writer of its own left in the landing folder."""
    zones = _zones(spark, "rescue")
    payloads = _careless_payloads(spark, sf_dir)
    rate_source.land_rates(payloads, zones.raw_rates, rescue=zones.rescued_rates)
    first = rate_source.read_rescued_rates(spark, zones.rescued_rates).select("date", "reason", F.lit("landing").alias("found"))
    cut = payloads.select(F.col("date").alias("data"), F.col("payload").alias("value"))
    cut.repartition("data").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("data").text(zones.raw_rates)
    seen = rate_source.rate_faults(rate_source.landed_payloads(spark, zones.raw_rates, dt.date(2024, 1, 1), dt.date(2024, 1, 31)))
    return first.unionByName(seen.select("date", "reason", F.lit("landed").alias("found")))


@query("scan_curated")
def scan_curated(spark, sf_dir):
    zones = _zones(spark, "scan-curated")
    upsert_partitioned(
        spark, zones.transactions, sample.dated_transactions(spark, sf_dir),
        TRANSACTION_KEY, CURATED_TRANSACTIONS,
    )
    return _comparable(read_table(spark, zones.transactions, CURATED_TRANSACTIONS))


@query("rates_from_records")
def rates_from_records(spark, sf_dir):
    records = sample.rate_records(sample.rates(spark, sf_dir))
    by_day = rate_source.rates_from_records(spark, records)
    days = sample.dated_transactions(spark, sf_dir).groupBy("date").agg(
        F.count(F.lit(1)).alias("movements"), F.sum("amount").cast("double").alias("amount")
    )
    return days.join(by_day.withColumnRenamed("data", "date"), "date", "left").select(
        "date", "valor", "movements", "amount"
    )


@query("table_exists")
def table_exists_check(spark, sf_dir):
    zones = _zones(spark, "exists")
    sinks.write_partitioned(sample.dated_transactions(spark, sf_dir), zones.transactions)
    states = [
        (name, table_exists(spark, path, schema))
        for name, path, schema in (
            ("transactions", zones.transactions, CURATED_TRANSACTIONS),
            ("payouts", zones.payouts, PAYOUTS),
        )
    ]
    stored = read_table(spark, zones.transactions, CURATED_TRANSACTIONS)
    return (
        spark.createDataFrame(states, "table_name string, present boolean")
        .crossJoin(stored.agg(F.count(F.lit(1)).alias("stored_rows")))
        .select(
            "table_name",
            F.col("present").cast("long").alias("present"),
            F.when(F.col("present"), F.col("stored_rows")).otherwise(F.lit(0))
            .cast("long").alias("stored_rows"),
        )
    )


@query("snapshot_first_load")
def snapshot_first_load(spark, sf_dir):
    return daily_snapshot(
        sample.dated_transactions(spark, sf_dir), sample.rates(spark, sf_dir),
        empty_table(spark, PAYOUTS), DAY,
    )


@query("rate_lookup")
def rate_lookup(spark, sf_dir):
    return rate_source.rate_lookup(sample.rates(spark, sf_dir), DAY)


@query("rates_normalize")
def rates_normalize(spark, sf_dir):
    return rate_source.normalize_rates(sample.rate_payloads(sample.rates(spark, sf_dir)))


# --- sinks ---

@query("write_partitioned")
def write_partitioned(spark, sf_dir):
    zones = _zones(spark, "write")
    sinks.write_partitioned(sample.dated_transactions(spark, sf_dir), zones.transactions)
    return _comparable(read_table(spark, zones.transactions, CURATED_TRANSACTIONS))


@query("write_rates")
def write_rates(spark, sf_dir):
    zones = _zones(spark, "write-rates")
    sinks.write_table(sample.rates(spark, sf_dir), zones.rates)
    return read_table(spark, zones.rates, RATES)


@query("merge_transactions")
def merge_transactions(spark, sf_dir):
    zones = _zones(spark, "merge")
    first, second = _deliveries(_numbered_events(spark, sf_dir), "event_id")
    columns = CURATED_TRANSACTIONS.fieldNames()
    sinks.write_partitioned(first.select(*columns), zones.transactions)
    upsert_partitioned(
        spark, zones.transactions, second.select(*columns), TRANSACTION_KEY, CURATED_TRANSACTIONS
    )
    return _comparable(read_table(spark, zones.transactions, CURATED_TRANSACTIONS))


@query("merge_rates")
def merge_rates(spark, sf_dir):
    zones = _zones(spark, "merge-rates")
    rates = sample.rates(spark, sf_dir)
    sinks.write_table(rates.where(F.col("date") <= F.lit(FIRST_DELIVERY_TO)), zones.rates)
    revised = rates.where(F.col("date") >= F.lit(REDELIVERY_FROM)).withColumn(
        "valor", F.col("valor") + F.lit(1.0)
    )
    upsert_table(spark, zones.rates, revised, RATE_KEY, RATES)
    return read_table(spark, zones.rates, RATES)


@query("merge_payouts")
def merge_payouts(spark, sf_dir):
    zones = _zones(spark, "merge-payouts")
    payouts = snapshot_chain(
        sample.dated_transactions(spark, sf_dir), sample.rates(spark, sf_dir)
    )
    third = F.col("user_id").cast("long") % 3
    sinks.write_partitioned(
        payouts.where((F.col("date") <= F.lit(FIRST_DELIVERY_TO)) & (third != 0)), zones.payouts
    )
    revised = payouts.where((F.col("date") >= F.lit(REDELIVERY_FROM)) & (third != 1)).withColumn(
        "saldo_final", F.col("saldo_final") + F.lit(1.0)
    )
    upsert_partitioned(
        spark, zones.payouts, revised, PAYOUT_KEY, PAYOUTS,
        days=sample.rates(spark, sf_dir).where(F.col("date") >= F.lit(REDELIVERY_FROM)),
        on_duplicate="keep_all",
        materialize=True,
    )
    return read_table(spark, zones.payouts, PAYOUTS)


@query("merge_evolve")
def merge_evolve(spark, sf_dir):
    first, second = _deliveries(_numbered_events(spark, sf_dir), "event_id")
    source = second.drop("channel", "event_id").withColumn("note", F.lit("redelivered"))
    merged = merge_upsert(
        first.drop("event_id"), source, TRANSACTION_KEY, on_duplicate="latest", latest_by=["amount"]
    )
    return _comparable(merged)


def _merged_orders(spark, sf_dir, **policy) -> DataFrame:
    """Orders repeat keys, in the stored rows and in the delivery."""
    orders = sample.numbered_orders(spark, sf_dir).withColumn("date", F.to_date("event_time"))
    first, second = _deliveries(orders, "order_id")
    columns = CURATED_TRANSACTIONS.fieldNames()
    return _comparable(
        merge_upsert(first.select(*columns), second.select(*columns), TRANSACTION_KEY, **policy)
    )


@query("merge_orders_keep_all")
def merge_orders_keep_all(spark, sf_dir):
    return _merged_orders(spark, sf_dir, on_duplicate="keep_all")


@query("merge_orders_latest")
def merge_orders_latest(spark, sf_dir):
    return _merged_orders(spark, sf_dir, on_duplicate="latest", latest_by=["amount"])


@query("merge_idempotent")
def merge_idempotent(spark, sf_dir):
    zones = _zones(spark, "merge-twice")
    first, second = _deliveries(_numbered_events(spark, sf_dir), "event_id")
    columns = CURATED_TRANSACTIONS.fieldNames()
    sinks.write_partitioned(first.select(*columns), zones.transactions)
    for _ in range(2):
        upsert_partitioned(
            spark, zones.transactions, second.select(*columns), TRANSACTION_KEY, CURATED_TRANSACTIONS
        )
    return _comparable(read_table(spark, zones.transactions, CURATED_TRANSACTIONS))


@query("overwrite_partitions")
def overwrite_partitions(spark, sf_dir):
    zones = _zones(spark, "overwrite")
    tx = sample.dated_transactions(spark, sf_dir)
    sinks.write_partitioned(tx, zones.transactions)
    late = tx.where(F.col("date") >= F.lit(REDELIVERY_FROM))
    sinks.overwrite_partitions(_corrected(late), zones.transactions)
    return _comparable(read_table(spark, zones.transactions, CURATED_TRANSACTIONS))


@query("land_rates")
def land_rates(spark, sf_dir):
    zones = _zones(spark, "land")
    payloads = sample.rate_payloads(sample.rates(spark, sf_dir))
    rate_source.land_rates(payloads, zones.raw_rates)
    # A day whose service answer is empty keeps what was landed before.
    rate_source.land_rates(payloads.withColumn("payload", F.lit("[]")), zones.raw_rates)
    landed = rate_source.read_landed_rates(spark, zones.raw_rates)
    return landed.select(
        rate_source.payload_date(F.col("data")).alias("date"),
        F.col("valor").try_cast("double").alias("valor"),
    )


# --- projections and filters ---

@query("filter_business_date")
def filter_business_date(spark, sf_dir):
    return _comparable(bal.filter_business_date(sample.transactions(spark, sf_dir), DAY))


@query("curate_transactions")
def curate_transactions(spark, sf_dir):
    return _comparable(bal.curate_transactions(sample.transactions(spark, sf_dir), DAY))


@query("curate_rates")
def curate_rates(spark, sf_dir):
    payloads = sample.rate_payloads(sample.rates(spark, sf_dir))
    day = payloads.where(F.col("date") == F.lit(DAY))
    landed = day.select(
        F.inline(F.from_json("payload", "array<struct<data:string,valor:string>>"))
    )
    return rate_source.curate_rates(landed, DAY)


@query("balance_until")
def balance_until(spark, sf_dir):
    return _comparable(bal.balance_until(sample.dated_transactions(spark, sf_dir), EVE))


@query("movement_of_day")
def movement_of_day(spark, sf_dir):
    return _comparable(bal.movement_of_day(sample.dated_transactions(spark, sf_dir), DAY))


@query("accounts_today")
def accounts_today(spark, sf_dir):
    return bal.accounts_today(sample.dated_transactions(spark, sf_dir), DAY)


@query("previous_closing")
def previous_closing(spark, sf_dir):
    return bal.previous_closing(_eve_payouts(spark, sf_dir), DAY)


# --- activity and ledger ---

@query("daily_activity")
def daily_activity(spark, sf_dir):
    return _comparable(act.daily_activity(sample.transactions(spark, sf_dir)))


@query("activity_lag")
def activity_lag(spark, sf_dir):
    tx = sample.transactions(spark, sf_dir)
    return _comparable(act.activity_lag(act.daily_activity(tx)))


@query("activity_with_rate")
def activity_with_rate(spark, sf_dir):
    lagged = act.activity_lag(act.daily_activity(sample.transactions(spark, sf_dir)))
    return _comparable(
        act.activity_with_rate(act.activity_between(lagged), sample.rates(spark, sf_dir))
    )


@query("gap_hours")
def gap_hours_between_days(spark, sf_dir):
    lagged = act.activity_lag(act.daily_activity(sample.transactions(spark, sf_dir)))
    return lagged.select(
        *ACCOUNT_KEY,
        F.to_date("event_date").alias("event_date"),
        gap_hours(F.col("event_time"), F.col("horario_saldo_elegivel")).alias("hours"),
    )


@query("union_days")
def union_days(spark, sf_dir):
    activity = act.daily_activity(sample.transactions(spark, sf_dir))
    day = F.to_date("event_date")
    parts = [
        act.activity_between(activity, to_date=EVE),
        act.activity_between(activity, DAY, DAY),
        activity.where(day > F.lit(DAY)),
        act.activity_between(activity, REDELIVERY_FROM, EVE),  # delivered twice: both stay
    ]
    return _comparable(act.union_days(parts))


@query("ledger")
def ledger_all_accounts(spark, sf_dir):
    return _comparable(ledger(sample.transactions(spark, sf_dir), sample.rates(spark, sf_dir)))


@query("ledger_one_account")
def ledger_one_account(spark, sf_dir):
    """Ledger of the account with the most movements."""
    tx = sample.transactions(spark, sf_dir)
    busiest = (
        tx.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "account_id").limit(1)
    )
    return _comparable(ledger(tx, sample.rates(spark, sf_dir), accounts=busiest))


@query("ledger_from_date")
def ledger_from_date(spark, sf_dir):
    return _comparable(ledger(
        sample.transactions(spark, sf_dir), sample.rates(spark, sf_dir),
        from_date=REDELIVERY_FROM, to_date=FIRST_DELIVERY_TO,
    ))


@query("ledger_report")
def ledger_report_columns(spark, sf_dir):
    rows = ledger(sample.transactions(spark, sf_dir), sample.rates(spark, sf_dir))
    return _comparable(ledger_report(rows))


@query("ledger_orders")
def ledger_orders(spark, sf_dir):
    return _comparable(ledger(
        sample.transactions_from_orders(spark, sf_dir), sample.order_rates(spark, sf_dir)
    ))


@query("ledger_continued")
def ledger_continued(spark, sf_dir):
    """Four runs, each from the state the one before left; late movements make one of them go back."""
    zones = _zones(spark, "ledger")
    sinks.write_table(sample.rates(spark, sf_dir), zones.rates)
    in_time, late = _late_halves(spark, sf_dir)
    dated = [rows.withColumn("date", F.to_date("event_time")) for rows in (in_time, late)]
    upsert_partitioned(spark, zones.transactions, dated[0], TRANSACTION_KEY, CURATED_TRANSACTIONS)
    for day in (dt.date(2024, 1, 8), EVE, WEEKEND):
        ledger_until(spark, zones, day)
    upsert_partitioned(spark, zones.transactions, dated[1], TRANSACTION_KEY, CURATED_TRANSACTIONS)
    ledger_until(spark, zones, dt.date(2024, 1, 31), from_date=REDELIVERY_FROM)
    return _comparable(read_table(spark, zones.ledger, LEDGER).select(*LEDGER_COLUMNS))


# --- snapshots ---

def _snapshot(spark, sf_dir):
    return daily_snapshot(
        sample.dated_transactions(spark, sf_dir), sample.rates(spark, sf_dir),
        _eve_payouts(spark, sf_dir), DAY,
    )


@query("daily_snapshot")
def daily_snapshot_day(spark, sf_dir):
    return _snapshot(spark, sf_dir)


@query("opening_balance")
def opening_balance(spark, sf_dir):
    return _snapshot(spark, sf_dir).select(*ACCOUNT_KEY, "saldo_a_mais_24_horas")


@query("eligible_balance")
def eligible_balance(spark, sf_dir):
    return _snapshot(spark, sf_dir).select(*ACCOUNT_KEY, "saldo_elegivel")


@query("daily_interest")
def daily_interest(spark, sf_dir):
    return _snapshot(spark, sf_dir).select(*ACCOUNT_KEY, "juros_calculado")


@query("closing_balance")
def closing_balance(spark, sf_dir):
    return _snapshot(spark, sf_dir).select(*ACCOUNT_KEY, "saldo_final")


@query("snapshot_no_rate")
def snapshot_no_rate(spark, sf_dir):
    """A day without a rate has no rows; those of a day with one stand beside it."""
    tx, rates = sample.dated_transactions(spark, sf_dir), sample.rates(spark, sf_dir)
    none, priced = (daily_snapshot(tx, rates, empty_table(spark, PAYOUTS), d) for d in (WEEKEND, DAY))
    return none.unionByName(priced)


@query("snapshot_chain")
def snapshot_chain_all_days(spark, sf_dir):
    return snapshot_chain(
        sample.dated_transactions(spark, sf_dir), sample.rates(spark, sf_dir)
    )


@query("snapshot_chain_orders")
def snapshot_chain_orders(spark, sf_dir):
    """Six years of payouts per account, summed up by day."""
    rows = snapshot_chain(
        sample.transactions_from_orders(spark, sf_dir), sample.order_rates(spark, sf_dir)
    )
    return rows.groupBy("date").agg(
        F.count(F.lit(1)).alias("accounts"),
        F.count(F.when(F.col("saldo_elegivel") > 0, 1)).alias("eligible_accounts"),
        F.max("saldo_a_mais_24_horas").alias("top_opening"),
        F.max("juros_calculado").alias("top_interest"),
        F.min("saldo_final").alias("low_closing"),
        F.max("saldo_final").alias("top_closing"),
        *[exact_sum(F.col(c)).cast("string").alias(f"sum_{c}") for c in PAYOUT_SUMS],
    )


# --- stages of a daily run ---

def _landed(spark, sf_dir, name: str) -> Zones:
    zones = _zones(spark, name)
    sample.transactions(spark, sf_dir).write.parquet(zones.raw_transactions)
    rate_source.land_rates(sample.rate_payloads(sample.rates(spark, sf_dir)), zones.raw_rates)
    return zones


def _curated_with_rate(spark, zones: Zones) -> DataFrame:
    rates = read_table(spark, zones.rates, RATES)
    return _comparable(
        read_table(spark, zones.transactions, CURATED_TRANSACTIONS).join(rates, "date", "left")
    )


@query("curate_day")
def curate_days(spark, sf_dir):
    zones = _landed(spark, sf_dir, "curate")
    for day in (DAY, EVE, DAY, WEEKEND):
        curate_day(spark, zones, day)
    return _curated_with_rate(spark, zones)


@query("curate_range")
def curate_days_at_once(spark, sf_dir):
    """A span of days in one run, then one of them again."""
    zones = _landed(spark, sf_dir, "curate-range")
    curate_range(spark, zones, REDELIVERY_FROM, WEEKEND)
    curate_range(spark, zones, EVE, DAY)
    return _curated_with_rate(spark, zones)


@query("curate_mixed_files")
def curate_mixed_files(spark, sf_dir):
    """Files with decimal and with floating-point amounts, one kind with a column more, in one directory."""
    zones = _zones(spark, "mixed")
    tx = sample.transactions_from_events(spark, sf_dir)
    even, odd = (tx.where(F.col("event_id") % 2 == n).drop("event_id") for n in (0, 1))
    even.drop("channel").write.parquet(zones.raw_transactions)
    odd.withColumn("amount", F.col("amount").cast("double")).write.mode("append").parquet(zones.raw_transactions)
    curate_range(spark, zones, EVE, DAY)
    return _comparable(read_table(spark, zones.transactions))


@query("file_manifest")
def file_manifest(spark, sf_dir):
    """What the manifest says of raw files, one delivery a week, taken together by their first day."""
    zones = _zones(spark, "manifest")
    tx = sample.transactions(spark, sf_dir)
    for week in range(5):
        rows = tx.where(F.floor((F.dayofmonth("event_time") - 1) / 7) == week).coalesce(1)
        rows.write.mode("append").parquet(zones.raw_transactions)
        manifest = refresh_manifest(spark, zones.raw_transactions, zones.manifest)
    return manifest.where("rows > 0").select("first_day", "last_day", F.col("rows").alias("row_count"), "undated")


@query("curate_no_data")
def curate_no_data(spark, sf_dir):
    zones = _landed(spark, sf_dir, "curate-none")
    curate_day(spark, zones, DAY)
    curate_day(spark, zones, AFTER_DATA)
    return _curated_with_rate(spark, zones)


@query("curate_evolved")
def curate_evolved(spark, sf_dir):
    """A raw column that no schema declares; the second day is delivered without it at first."""
    zones = _zones(spark, "evolved")
    raw = sample.transactions_from_events(spark, sf_dir).drop("event_id")
    raw.write.parquet(zones.raw_transactions)
    curate_transactions_day(spark, zones, read_transactions(spark, zones.raw_transactions), EVE)
    curate_transactions_day(spark, zones, sample.transactions(spark, sf_dir), DAY)
    curate_transactions_day(spark, zones, read_transactions(spark, zones.raw_transactions), DAY)
    return _comparable(read_table(spark, zones.transactions))


@query("curate_orders")
def curate_orders(spark, sf_dir):
    """Movements of one account in the same instant all stay."""
    zones = _zones(spark, "orders")
    sample.transactions_from_orders(spark, sf_dir).write.parquet(zones.raw_transactions)
    curate_arrivals(spark, zones, f"{zones.base}/progress").awaitTermination()
    return _comparable(read_table(spark, zones.transactions, CURATED_TRANSACTIONS))


@query("curate_arrivals")
def curate_arriving_files(spark, sf_dir):
    zones = _zones(spark, "arrivals")
    sample.transactions(spark, sf_dir).write.parquet(zones.raw_transactions)
    curate_arrivals(spark, zones, f"{zones.base}/progress").awaitTermination()
    return _comparable(read_table(spark, zones.transactions, CURATED_TRANSACTIONS))


@query("stream_in_batches")
def stream_in_batches(spark, sf_dir):
    """Movements and rates as streams, a delivery or a few files a batch, rows and rates coming more than once, in two calls."""
    zones = _zones(spark, "stream")
    tx, rates = sample.transactions(spark, sf_dir), sample.rates(spark, sf_dir)
    day = F.dayofmonth("event_time")
    deliveries = [tx.where(part).repartition(spark.sparkContext.defaultParallelism) for part in (day < 18, day >= 12)]
    deliveries[0].write.parquet(zones.raw_transactions)
    # A batch takes as many files as the first delivery has, however many tasks wrote them.
    files = listed_files(spark, zones.raw_transactions).count()
    deliveries[1].write.mode("append").parquet(zones.raw_transactions)
    lower = rates.withColumn("valor", F.col("valor") / 2)
    for part in (lower, rates.where(F.dayofmonth("date") <= 9)):
        _append_rates(part.coalesce(2), zones.raw_rates)
        curate_arrivals(spark, zones, f"{zones.base}/seen", files, on_duplicate="distinct").awaitTermination()
        curate_rate_arrivals(spark, zones, f"{zones.base}/rates_seen", 8).awaitTermination()
    return _curated_with_rate(spark, zones)


def _append_rates(rates: DataFrame, root: str) -> None:
    """Land rates beside those already landed for their days, as a service that answers twice does."""
    payloads = sample.rate_payloads(rates).select(F.col("date").alias("data"), F.col("payload").alias("value"))
    payloads.write.mode("append").partitionBy("data").text(root)


@query("merge_orders_distinct")
def merge_orders_distinct(spark, sf_dir):
    return _merged_orders(spark, sf_dir, on_duplicate="distinct")


@query("merge_orders_replace")
def merge_orders_replace(spark, sf_dir):
    return _merged_orders(spark, sf_dir, on_duplicate="replace")


@query("payouts_of_days")
def payouts_of_days(spark, sf_dir):
    """Range job up to the eve, then two daily runs on top of what it wrote."""
    zones = _landed(spark, sf_dir, "payouts")
    upsert_partitioned(
        spark, zones.transactions,
        sample.dated_transactions(spark, sf_dir), TRANSACTION_KEY, CURATED_TRANSACTIONS,
    )
    sinks.write_table(sample.rates(spark, sf_dir), zones.rates)
    curate_rate_day(spark, zones, DAY)
    payouts_range(spark, zones, dt.date(2024, 1, 1), EVE)
    payouts_day(spark, zones, DAY)
    payouts_day(spark, zones, DAY)
    payouts_day(spark, zones, WEEKEND)
    return read_table(spark, zones.payouts, PAYOUTS)


def _late_halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Movements in time, and a third of those from a day on, which arrive when payouts are already there."""
    tx = _numbered_events(spark, sf_dir)
    late = (F.col("event_id") % 3 == 0) & (F.col("date") >= F.lit(REDELIVERY_FROM))
    return tx.where(~late).select(*TRANSACTIONS.fieldNames()), tx.where(late).select(*TRANSACTIONS.fieldNames())


def _with_late_movements(spark, sf_dir, name: str) -> Zones:
    zones = _zones(spark, name)
    in_time, late = _late_halves(spark, sf_dir)
    sinks.write_table(sample.rates(spark, sf_dir), zones.rates)
    upsert_partitioned(
        spark, zones.transactions, in_time.withColumn("date", F.to_date("event_time")), TRANSACTION_KEY, CURATED_TRANSACTIONS
    )
    payouts_range(spark, zones, dt.date(2024, 1, 1), EVE)
    payouts_range(spark, zones, DAY, dt.date(2024, 1, 31))
    for day in (REDELIVERY_FROM, EVE, DAY, WEEKEND):
        curate_transactions_day(spark, zones, late, day)
    return zones


@query("totals_restated")
def totals_restated(spark, sf_dir):
    """Totals of two days after late movements of several days."""
    zones = _with_late_movements(spark, sf_dir, "totals")
    refresh_totals(spark, zones)
    return _comparable(read_table(spark, zones.totals, TOTALS))


@query("payouts_restated")
def payouts_restated(spark, sf_dir):
    """Late movements of several days, folded again for their accounts only."""
    zones = _with_late_movements(spark, sf_dir, "restated")
    restate_payouts(spark, zones)
    return read_table(spark, zones.payouts, PAYOUTS)


# --- quality ---

@query("tx_quality")
def tx_quality(spark, sf_dir):
    return key_quality(sample.transactions(spark, sf_dir), TRANSACTION_KEY)


@query("tx_quality_orders")
def tx_quality_orders(spark, sf_dir):
    return key_quality(sample.transactions_from_orders(spark, sf_dir), TRANSACTION_KEY)


@query("rate_quality")
def rate_quality(spark, sf_dir):
    landed = sample.dated_transactions(spark, sf_dir).select("date")
    return key_quality(landed.join(sample.rates(spark, sf_dir), "date"), RATE_KEY)


@query("dedup_latest")
def dedup_latest_orders(spark, sf_dir):
    return _comparable(dedup_latest(
        sample.transactions_from_orders(spark, sf_dir), TRANSACTION_KEY, ["amount"]
    ))


# Amounts beyond this are taken for errors.
MOST = 400


def _faulty(spark, sf_dir) -> DataFrame:
    """Events as delivered by a careless source: all text, some of it broken, some rows sent twice."""
    tx = sample.transactions_from_events(spark, sf_dir)
    n = F.col("event_id")
    broken = tx.select(
        "user_id",
        F.when(n % 89 != 0, F.col("account_id")).alias("account_id"),
        F.when(n % 83 == 0, F.lit("yesterday")).when(n % 79 != 0, F.col("event_time").cast("string")).alias("event_time"),
        F.when(n % 97 == 0, F.lit("n/a")).otherwise(F.col("amount").cast("string")).alias("amount"),
        "channel",
        "event_id",
    )
    return broken.unionByName(broken.where(n % 71 == 0))


_LIMITED = replace(TRANSACTION_RULES, ranges={"amount": (-MOST, MOST)})


def _validated(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return validated(_faulty(spark, sf_dir), _LIMITED)


@query("tx_validated")
def tx_validated(spark, sf_dir):
    return _comparable(_validated(spark, sf_dir)[0])


@query("tx_rejected")
def tx_rejected(spark, sf_dir):
    _, rejected = _validated(spark, sf_dir)
    return rejected.select("event_id", F.concat_ws(", ", "reasons").alias("reasons"))


@query("reject_reasons")
def reject_reasons(spark, sf_dir):
    return reasons_report(_validated(spark, sf_dir)[1]).select("reason", F.col("rows").alias("row_count"))


@query("curate_validated")
def curate_validated_days(spark, sf_dir):
    """Days curated by the rules, twice; beside each the rows that were rejected."""
    zones = _zones(spark, "validated")
    _faulty(spark, sf_dir).drop("event_id").write.parquet(zones.raw_transactions)
    for _ in range(2):
        curate_validated(spark, zones, EVE, DAY, _LIMITED, on_duplicate="replace")
    stored = read_table(spark, zones.transactions).groupBy("date").agg(
        F.count("*").alias("accepted"), F.sum("amount").cast("double").alias("amount")
    )
    rejected = read_table(spark, zones.rejected).groupBy("date").agg(F.count("*").alias("rejected"))
    return stored.join(rejected, stored["date"].eqNullSafe(rejected["date"]), "full").select(
        F.coalesce(stored["date"], rejected["date"]).alias("date"), "accepted", "amount", "rejected"
    )
