"""Curate rates as their files are landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybook.operators.merge import upsert_table
from tallybook.plans.zones import Zones
from tallybook.schemas import RATE_KEY, RATE_PAYLOAD, RATES
from tallybook.sources.workspace import scratch


def curate_rate_arrivals(
    spark: SparkSession, zones: Zones, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Upsert the rates of all files that were landed since the last call, then stop.

    The greatest rate of each landing date is kept in the stream's state over all batches, so the result does not
    depend on how files are grouped into them, nor on their order, as it would if each batch chose for itself. The
    state has one row a date, so the calendar bounds it, and a rate may come as late as it likes. A batch that is
    repeated after a failure upserts the same rows again.
    """
    reader = spark.readStream.schema(RATE_PAYLOAD).option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # The folder is named like a column of the records, so the day comes from the path.
    day = F.to_date(F.regexp_extract(F.col("_metadata.file_path"), r"/data=(\d{4}-\d{2}-\d{2})/", 1))
    greatest = (
        reader.json(zones.raw_rates)
        .select(day.alias("date"), F.col("valor").try_cast("double").alias("valor"))
        .where(F.col("date").isNotNull())
        .groupBy("date")
        .agg(F.max("valor").alias("valor"))
    )

    def upsert(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        with scratch(session) as copies:
            # Every use of the batch itself would read and write the whole state once more.
            changed = copies.keep(batch, "rates")
            if not changed.isEmpty():
                upsert_table(session, zones.rates, changed, RATE_KEY, RATES, on_duplicate="keep_all")

    return (
        greatest.writeStream.outputMode("update")
        .foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
