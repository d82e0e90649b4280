"""Daily rates: payload text, landed JSON files, records, and lookups."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.interest import as_date, rate_fraction
from tallybook.schemas import PAYLOAD_DATE_FORMAT, RATE_FAULTS, RATE_PAYLOAD, RATE_RECORDS, RATES
from tallybook.sources import files
from tallybook.sources.tables import empty_table, is_missing_path, read_table_or_empty

log = logging.getLogger(__name__)


def payload_date(text: Column) -> Column:
    """Date of a payload record; NULL where the text is not one."""
    return F.to_date(F.try_to_timestamp(text, F.lit(PAYLOAD_DATE_FORMAT)))


def rates_from_records(
    spark: SparkSession, records: Iterable[Mapping[str, object]]
) -> DataFrame:
    """Rates from already decoded records ``{"data": "dd/MM/yyyy", "valor": ...}``."""
    rows = [(r["data"], float(r["valor"])) for r in records]
    return spark.createDataFrame(rows, RATE_RECORDS).withColumn("data", payload_date(F.col("data")))


def normalize_rates(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """JSON array text, one payload per row, to ``(data DATE, valor DOUBLE)``."""
    return (
        payloads
        .select(F.inline(F.from_json(payload, "array<struct<data:string,valor:string>>")))
        .select(
            payload_date(F.col("data")).alias("data"),
            F.col("valor").try_cast("double").alias("valor"),
        )
    )


def rate_faults(payloads: DataFrame) -> DataFrame:
    """``date, payload, reason`` of what cannot be used among ``(date, payload)`` rows.

    A payload that is no JSON array of objects is a fault as a whole; within one that is, each record without a date, with a date of
    another day, without a number, or that is no object is one. Empty payloads and empty arrays are no faults: there is no rate on that day.
    """
    text = F.trim("payload")
    given = payloads.where((text != "") & text.isNotNull())
    items = F.from_json("payload", "array<string>")
    broken = F.json_array_length("payload").isNull()
    whole = given.where(broken).select("date", "payload", F.lit("no array").alias("reason"))
    records = given.where(~broken).select("date", F.explode(items).alias("payload"))
    record = F.from_json("payload", RATE_PAYLOAD)
    day = payload_date(record["data"])
    reason = (
        F.when(F.col("payload").isNull() | ~F.trim("payload").startswith("{") | record.isNull(), "no object")
        .when(day.isNull(), "no date")
        .when(day != F.col("date"), "other day")
        .when(record["valor"].try_cast("double").isNull(), "no number")
    )
    single = records.select("date", "payload", reason.alias("reason")).where(F.col("reason").isNotNull())
    return whole.unionByName(single)


def rescue_rates(payloads: DataFrame, root: str) -> None:
    """Keep the faults of the given days apart under ``date=YYYY-MM-DD/``, in place of those they had."""
    spark = payloads.sparkSession
    faults = rate_faults(payloads)
    kept = {row["date"] for row in faults.select("date").distinct().collect()}
    for row in payloads.select("date").distinct().collect():
        if row["date"] not in kept:
            files.remove(spark, f"{root}/date={row['date']}")
    if kept:
        log.warning("faulty rate payloads of %s days are kept in %s", len(kept), root)
        (
            faults.repartition("date").write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date")
            .parquet(root)
        )


def read_rescued_rates(spark: SparkSession, root: str) -> DataFrame:
    return read_table_or_empty(spark, root, RATE_FAULTS)


def land_rates(payloads: DataFrame, root: str, rescue: str | None = None) -> None:
    """Land ``(date, payload)`` rows under ``data=YYYY-MM-DD/``, replacing the days given.

    Days with an empty payload write nothing and keep what was landed before, and so do payloads that are no JSON
    array. Given a folder ``rescue``, faulty payloads and records are kept there instead of being passed over.
    """
    if rescue is not None:
        rescue_rates(payloads, rescue)
    usable = F.json_array_length("payload") > 0
    (
        payloads.where(usable)
        .select(F.col("date").alias("data"), F.col("payload").alias("value"))
        .repartition("data")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("data")
        .text(root)
    )


def read_landed_rates(
    spark: SparkSession, root: str, business_date: str | dt.date | None = None
) -> DataFrame:
    """Landed payload records of one day, or of every day when none is given.

    A day that was never landed gives no rows; any other failure is raised.
    """
    day = "*" if business_date is None else as_date(business_date).isoformat()
    try:
        return spark.read.schema(RATE_PAYLOAD).json(f"{root}/data={day}")
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        log.warning("no rate landed for %s", day)
        return empty_table(spark, RATE_PAYLOAD)


def read_landed_days(
    spark: SparkSession, root: str, first: dt.date, last: dt.date
) -> DataFrame:
    """Curated rows of the rates landed for some days; days that were never landed give none."""
    # The folder and a column of the records are both named ``data``, so the day is taken from the file's path.
    day = F.to_date(F.regexp_extract(F.col("_metadata.file_path"), r"/data=(\d{4}-\d{2}-\d{2})/", 1))
    names = ",".join((first + dt.timedelta(days=n)).isoformat() for n in range((last - first).days + 1))
    try:
        landed = spark.read.schema(RATE_PAYLOAD).json(f"{root}/data={{{names}}}")
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return empty_table(spark, RATES)
    return landed.select(day.alias("date"), F.col("valor").try_cast("double").alias("valor"))


def landed_payloads(spark: SparkSession, root: str, first: dt.date, last: dt.date) -> DataFrame:
    """``(date, payload)`` as landed for some days, one row a line of a file, so that faults of any writer are seen."""
    day = F.to_date(F.regexp_extract(F.col("_metadata.file_path"), r"/data=(\d{4}-\d{2}-\d{2})/", 1))
    names = ",".join((first + dt.timedelta(days=n)).isoformat() for n in range((last - first).days + 1))
    try:
        return spark.read.text(f"{root}/data={{{names}}}").select(day.alias("date"), F.col("value").alias("payload"))
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return spark.createDataFrame([], "date date, payload string")


def curate_rates(landed: DataFrame, business_date: str | dt.date) -> DataFrame:
    """Landed records of one day to curated rows; the run date is the key."""
    return landed.select(
        F.lit(as_date(business_date)).alias("date"),
        F.col("valor").try_cast("double").alias("valor"),
    )


def unique_rates(rates: DataFrame) -> DataFrame:
    """One usable rate per date, so the frame never has more rows than the calendar has days.

    Every broadcast of rates goes through here: that row count is its size bound.
    """
    return (
        rates.where(F.col("date").isNotNull() & F.col("valor").isNotNull())
        .groupBy("date")
        .agg(F.max("valor").alias("valor"))
    )


def rate_lookup(rates: DataFrame, business_date: str | dt.date) -> DataFrame:
    """Rate of one day as a fraction: one row, or none when the day has no rate."""
    day = rates.where(F.col("date") == F.lit(as_date(business_date)))
    return unique_rates(day).select(rate_fraction(F.col("valor")).alias("rate"))
