"""Sample tables as transactions and rates."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.schemas import CURATED_TRANSACTIONS, PAYLOAD_DATE_FORMAT, TRANSACTIONS


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as account movements: purchases and errors debit, the rest credit."""
    value = F.col("value").cast("decimal(18,2)")
    debit = F.col("event_type").isin("purchase", "error")
    return load(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("user_id"),
        (F.col("user_id") * 10 + F.col("event_id") % 2).cast("string").alias("account_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.when(debit, -value).otherwise(value).cast("decimal(18,2)").alias("amount"),
        F.col("event_type").alias("channel"),
        "event_id",
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(spark, sf_dir).select(*TRANSACTIONS.fieldNames())


def dated_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with the ``date`` column curated tables are partitioned by."""
    return (
        transactions(spark, sf_dir)
        .withColumn("date", F.to_date("event_time"))
        .select(*CURATED_TRANSACTIONS.fieldNames())
    )


def transactions_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered_orders(spark, sf_dir).select(*TRANSACTIONS.fieldNames())


def numbered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as movements, all at midnight; a customer may have several at one time."""
    value = F.col("o_totalprice").cast("decimal(18,2)")
    return load(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_custkey").cast("string").alias("account_id"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
        F.when(F.col("o_orderstatus") == "F", -value).otherwise(value)
        .cast("decimal(18,2)").alias("amount"),
        F.col("o_orderkey").alias("order_id"),
    )


def weekday_rates(times: DataFrame, time: str) -> DataFrame:
    """A rate for every weekday with rows, by how many there are."""
    per_day = times.groupBy(F.to_date(time).alias("date")).agg(F.count(F.lit(1)).alias("n"))
    rate = (F.lit(400) + F.col("n") % 100) / F.lit(10000.0)
    return per_day.where(F.weekday("date") < 5).select("date", rate.alias("valor"))


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekday_rates(load(spark, sf_dir, "events"), "ts")


def order_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekday_rates(load(spark, sf_dir, "orders"), "o_orderdate")


def rate_payloads(rate_rows: DataFrame) -> DataFrame:
    """One payload text per day, as a rate service returns it."""
    record = F.struct(
        F.date_format("date", PAYLOAD_DATE_FORMAT).alias("data"),
        F.col("valor").cast("string").alias("valor"),
    )
    return rate_rows.select("date", F.to_json(F.array(record)).alias("payload"))


def rate_records(rate_rows: DataFrame) -> Iterator[dict[str, str]]:
    """The same rates as decoded records, at most one per calendar day."""
    for date, valor in rate_rows.orderBy("date").collect():
        yield {"data": date.strftime("%d/%m/%Y"), "valor": str(valor)}
